"""The model graph as lazy DataFrames.

``BankModels`` wires raw tables into every staging, intermediate and mart
model. Nothing runs until an action; Catalyst sees the whole chain, so filters
and column pruning reach the scans. Models read by several others
(calendar, enriched transactions, spine) can be materialized once with
``materialize_shared`` to cut lineage and avoid recomputation.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from ledgerline.functions import labels as L
from ledgerline.operators.joins import fits
from ledgerline.plans import intermediate as I
from ledgerline.plans import marts as M
from ledgerline.plans import staging as S

# Parameters of compared runs (the reference uses CURRENT_DATE() and 2020-01-01).
AS_OF = dt.date(2001, 12, 31)
DEFAULT_START = dt.date(1995, 1, 1)


class BankModels:
    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        as_of: dt.date = AS_OF,
        default_start: dt.date = DEFAULT_START,
        auto_scale: bool = False,
    ):
        self.raw = raw
        self.auto_scale = auto_scale
        self.as_of = as_of
        self.default_start = default_start
        self._overrides: dict[str, DataFrame] = {}

    def _get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._overrides:
            self._overrides[name] = build()
        return self._overrides[name]

    def bound(self, table: str) -> int | None:
        """Proven row bound of a raw table, when its source knows one."""
        fn = getattr(self.raw, "row_bound", None)
        return fn(table) if fn else None

    def lookup_bounds(self, *tables: str) -> dict[str, int | None]:
        return {t: self.bound(t) for t in tables}

    @property
    def calendar_fits(self) -> bool:
        """Broadcast verdict for the calendar, reached once for all its consumers.

        Proven when d_time's size is known and the lookups cannot fan out;
        otherwise one counting job on the calendar decides.
        """
        if "_calendar_fits" not in self.__dict__:
            known = self.bound("d_time") if getattr(self.raw, "unique_lookup_keys", False) else None
            self.__dict__["_calendar_fits"] = fits(self.base_time_dimension, S.LOOKUP_MAX_ROWS, known_rows=known)
        return self.__dict__["_calendar_fits"]

    def replace(self, name: str, df: DataFrame) -> None:
        """Swap a model for a materialized copy (downstream models then read it)."""
        self._overrides[name] = df

    # -- staging ------------------------------------------------------------------
    @property
    def stg_accounts(self) -> DataFrame:
        return self._get("stg_accounts", lambda: S.stg_accounts(self.raw["accounts"]))

    @property
    def stg_customers(self) -> DataFrame:
        return self._get("stg_customers", lambda: S.stg_customers(self.raw["customers"]))

    @property
    def stg_pix_movements(self) -> DataFrame:
        return self._get("stg_pix_movements", lambda: S.stg_pix_movements(self.raw["pix_movements"], self.auto_scale))

    @property
    def stg_transfer_ins(self) -> DataFrame:
        return self._get("stg_transfer_ins", lambda: S.stg_transfer_ins(self.raw["transfer_ins"], self.auto_scale))

    @property
    def stg_transfer_outs(self) -> DataFrame:
        return self._get("stg_transfer_outs", lambda: S.stg_transfer_outs(self.raw["transfer_outs"], self.auto_scale))

    @property
    def base_location_hierarchy(self) -> DataFrame:
        return self._get(
            "base_location_hierarchy",
            lambda: S.base_location_hierarchy(
                self.raw["city"], self.raw["state"], self.raw["country"], self.lookup_bounds("state", "country")
            ),
        )

    @property
    def base_time_dimension(self) -> DataFrame:
        r = self.raw
        return self._get(
            "base_time_dimension",
            lambda: S.base_time_dimension(
                r["d_time"], r["d_week"], r["d_month"], r["d_year"], r["d_weekday"],
                self.lookup_bounds("d_week", "d_month", "d_year", "d_weekday"),
            ),
        )

    # -- intermediate ---------------------------------------------------------------
    @property
    def int_unified_transactions(self) -> DataFrame:
        return self._get("int_unified_transactions", lambda: I.int_unified_transactions(self.stg_pix_movements, *self._stg_transfers()))

    def _stg_transfers(self) -> list[DataFrame]:
        """The staged transfer feeds: in one pass where the source has both in one table, else one by one."""
        both = getattr(self.raw, "transfers", None)
        if both is not None and not {"stg_transfer_ins", "stg_transfer_outs"} & self._overrides.keys():
            return [S.stg_both_transfers(both, self.auto_scale)]
        return [self.stg_transfer_ins, self.stg_transfer_outs]

    def _on_own_months(self, per_month: DataFrame) -> DataFrame:
        return I.on_own_months(
            self.stg_accounts, self.base_time_dimension, per_month, self.as_of, self.default_start, self.calendar_fits
        )

    @property
    def int_transactions_enriched(self) -> DataFrame:
        return self._get(
            "int_transactions_enriched",
            lambda: I.int_transactions_enriched(
                self.int_unified_transactions, self.base_time_dimension, calendar_fits=self.calendar_fits
            ),
        )

    @property
    def int_account_monthly_spine(self) -> DataFrame:
        return self._get(
            "int_account_monthly_spine",
            lambda: I.int_account_monthly_spine(
                self.stg_accounts, self.base_time_dimension, self.int_unified_transactions,
                as_of=self.as_of, default_start=self.default_start, calendar_fits=self.calendar_fits,
            ),
        )

    @property
    def int_monthly_transaction_summary(self) -> DataFrame:
        return self._get(
            "int_monthly_transaction_summary",
            lambda: I.monthly_summary(self._on_own_months(I.monthly_measures(self.int_transactions_enriched))),
        )

    def int_transactions_summary(self, literal: bool = False) -> DataFrame:
        labels = (L.SUMMARY_LITERAL_IN, L.SUMMARY_LITERAL_OUT) if literal else (L.DIRECTION_IN, L.DIRECTION_OUT)
        return self._get(
            f"int_transactions_summary{'_literal' if literal else ''}",
            lambda: I.transactions_summary(self._on_own_months(I.summary_measures(self.int_transactions_enriched, *labels))),
        )

    # -- marts ------------------------------------------------------------------------
    @property
    def dim_account(self) -> DataFrame:
        return self._get("dim_account", lambda: M.dim_account(self.stg_accounts, self.int_transactions_enriched, self.as_of))

    @property
    def dim_calendar(self) -> DataFrame:
        return self._get("dim_calendar", lambda: M.dim_calendar(self.base_time_dimension))

    @property
    def dim_customer(self) -> DataFrame:
        return self._get("dim_customer", lambda: M.dim_customer(self.stg_customers))

    def fct_transactions(self, literal: bool = False) -> DataFrame:
        labels = (L.FACT_LITERAL_IN, L.FACT_LITERAL_OUT) if literal else (L.DIRECTION_IN, L.DIRECTION_OUT)
        return self._get(
            f"fct_transactions{'_literal' if literal else ''}",
            lambda: M.fct_transactions(self.int_transactions_enriched, *labels),
        )

    @property
    def fct_account_monthly_balances(self) -> DataFrame:
        return self._get(
            "fct_account_monthly_balances", lambda: M.fct_account_monthly_balances(self.int_monthly_transaction_summary)
        )

    def balances_of_accounts(self, accounts: DataFrame) -> DataFrame:
        """``fct_account_monthly_balances`` of ``intermediate.accounts_with_months``: row by row, in the accounts' order."""
        on_spine = I.expand_months(accounts, self.base_time_dimension, self.as_of, self.default_start, self.calendar_fits)
        return M.fct_account_monthly_balances(I.monthly_summary(on_spine))

    @property
    def report_monthly_business_kpi(self) -> DataFrame:
        # The spine is unique per (account, month_date, year, month) by construction
        # (distinct accounts, each expanding distinct months, joined to distinct
        # calendar months), and the summary joins it to one aggregate row per key,
        # so the balances keep that uniqueness: distinct counts are plain counts.
        return self._get(
            "report_monthly_business_kpi",
            lambda: M.report_monthly_business_kpi(self.fct_account_monthly_balances, unique_account_months=True),
        )

    @property
    def report_customer_segmentation(self) -> DataFrame:
        return self._get("report_customer_segmentation", lambda: M.report_customer_segmentation(self.dim_customer))
