"""Models over tables bucketed by account: the facts are shuffled when they are written, and never by a model again.

Each model is the same composition of the functions in ``intermediate`` and ``marts`` as in the model graph, applied to
the two disjoint parts of the facts (``sources/buckets.py``): in the bucketed part grouping by account and the join with
the accounts need no exchange; the hot accounts' part is reduced by partial sums first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.plans import intermediate as I
from ledgerline.plans import marts as M
from ledgerline.plans.models import BankModels
from ledgerline.sources.buckets import Bucketed, attach, buckets_for, grouped, split_by_hot, write_bucketed

KEY = "account_id"
#: Columns of the enriched transactions that the models below read.
ENRICHED = [
    "transaction_id", "account_id", "transaction_channel", "transaction_direction", "transaction_amount", "signed_amount",
    "transaction_completed_at", "completed_month_date", "transaction_size_category",
]


@dataclass(frozen=True)
class BucketedModels:
    accounts: Bucketed
    enriched: Bucketed
    unified: Bucketed
    graph: BankModels

    @staticmethod
    def write(graph: BankModels, root: str, buckets: int = 64) -> BucketedModels:
        """Write the three tables below ``root``, all in the same number of buckets: at least ``buckets``, more where the
        accounts or the transactions need them (``buckets_for``)."""
        root = root.rstrip("/")
        least = buckets_for(graph.stg_accounts.count(), buckets)
        unified = write_bucketed(graph.int_unified_transactions, f"{root}/unified", KEY, least, grow=True)
        buckets = unified.buckets
        # enriched from the written table, as in a full run: nothing is built twice
        enriched = I.int_transactions_enriched(unified.all(), graph.base_time_dimension, calendar_fits=graph.calendar_fits)
        return BucketedModels(
            write_bucketed(graph.stg_accounts, f"{root}/accounts", KEY, buckets, split_hot=False),
            write_bucketed(enriched.select(*ENRICHED), f"{root}/enriched", KEY, buckets),
            unified,
            graph,
        )

    @staticmethod
    def open(spark: SparkSession, graph: BankModels, root: str) -> BucketedModels:
        """The tables that ``write`` left below ``root``, also those of another session."""
        return BucketedModels(*(attach(spark, f"{root.rstrip('/')}/{t}") for t in ("accounts", "enriched", "unified")), graph)

    def dim_account(self) -> DataFrame:
        parts = zip(split_by_hot(self.accounts, self.enriched.hot_keys), (self.enriched.cold, self.enriched.hot), strict=True)
        out = [M.dim_account(accounts, facts, self.graph.as_of) for accounts, facts in parts]
        return out[0].unionByName(out[1])

    def int_monthly_transaction_summary(self) -> DataFrame:
        g = self.graph
        parts = zip(split_by_hot(self.accounts, self.enriched.hot_keys), (self.enriched.cold, self.enriched.hot), strict=True)
        out = [
            I.monthly_summary(I.on_own_months(accounts, g.base_time_dimension, I.monthly_measures(facts), g.as_of, g.default_start, g.calendar_fits))
            for accounts, facts in parts
        ]
        return out[0].unionByName(out[1])

    def orphan_transactions(self) -> DataFrame:
        """Transactions per account that doesn't exist (null accounts too), as ``quality.orphan_transactions``."""
        cold, hot = grouped(self.unified, [], [F.count(F.lit(1)).alias("orphaned_transactions")])
        ids, hot_ids = (a.select(KEY) for a in split_by_hot(self.accounts, self.unified.hot_keys))
        return cold.join(ids.hint("merge"), KEY, "left_anti").unionByName(hot.join(F.broadcast(hot_ids), KEY, "left_anti"))
