"""Driver test tables -> the 13 raw bank tables.

The test data is TPC-H shaped (customer, orders, lineitem, nation, region). This
adapter derives the bank's raw tables from them with plain column expressions so
every model downstream reads real, growing data:

* accounts / customers  <- customer
* pix_movements         <- orders
* transfer_ins / _outs  <- lineitem join orders (every line goes to one of the two feeds)
* city / state          <- nation / region
* country               <- region (one country per region; names from a fixed list)
* d_time and lookups    <- the days of the years spanned by order and ship dates; as in a raw feed a few days are
  missing and a few carry two timestamps

The modulo expressions only synthesise bank attributes (status, direction,
missing values). Every driver row becomes a bank row: orphan transactions and
accounts without transactions come from remapping a few ids to values no
other table uses, never from dropping rows.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.timeparse import day_sequence, ts_to_epoch
from ledgerline.sources.schemas import DECIMAL, conform

# --- fixed values: country names (by country id 1..5) and adapter constants ----
COUNTRY_NAMES = ["Brazil", "Argentina", "Mexico", "Colombia", "Chile"]
ACCOUNT_EPOCH = dt.date(1995, 1, 1)
MALFORMED_TIME_ID = -1
# Calendar days (by day number since 1970-01-01) that the feed misses, and days with a second, noon timestamp.
MISSING_DAY = (97, 13)
DOUBLE_DAY = (61, 7)
# Id offsets that make a key match nothing on the other side.
UNLISTED_ACCOUNT_OFFSET = 1_000_000_000_000     # accounts no transaction points at
ORPHAN_ACCOUNT_OFFSET = 2_000_000_000_000       # transactions of accounts that do not exist


def _transaction_account(custkey):
    """Account of an order's transactions; 1 customer in 50 points at a missing account."""
    return F.when(custkey % 50 == 7, custkey + F.lit(ORPHAN_ACCOUNT_OFFSET)).otherwise(custkey)


class RawTables:
    """Lazy accessors for the 13 raw tables built from a driver parquet folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    # -- driver tables ----------------------------------------------------------
    def driver(self, name: str) -> DataFrame:
        key = f"driver:{name}"
        if key not in self._cache:
            self._cache[key] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[key]

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._cache:
            self._cache[table] = conform(getattr(self, f"_build_{table}")(), table)
        return self._cache[table]

    # Lookup tables generated here have unique keys, so joining them cannot fan out.
    unique_lookup_keys = True

    def row_bound(self, table: str) -> int | None:
        """Upper bound of a table's rows proven by how it is generated (None: unknown)."""
        if not table.startswith("d_"):
            return None
        lo, hi = self.calendar_bounds()
        days = (hi - lo).days + 1
        return {"d_time": days + 1 + -(-days // DOUBLE_DAY[0]), "d_week": 53, "d_month": 12, "d_year": hi.year - lo.year + 1, "d_weekday": 7}[table]

    def names(self) -> list[str]:
        return [
            "pix_movements", "transfer_ins", "transfer_outs", "accounts", "customers", "city",
            "state", "country", "d_time", "d_week", "d_month", "d_year", "d_weekday",
        ]

    # -- accounts and customers <- customer --------------------------------------
    def _build_accounts(self) -> DataFrame:
        c = self.driver("customer").select("c_custkey", "c_name")
        key = F.col("c_custkey")
        return c.select(
            F.when(key % 50 == 49, key + F.lit(UNLISTED_ACCOUNT_OFFSET)).otherwise(key).alias("account_id"),
            F.col("c_name").alias("account_name"),
            F.date_add(F.lit(ACCOUNT_EPOCH), (key % 2000).cast("int")).cast("timestamp_ntz").alias("created_at"),
            F.when(key % 10 == 3, "inactive").otherwise("active").alias("status"),
        )

    def _build_customers(self) -> DataFrame:
        c = self.driver("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        key = F.col("c_custkey")
        name, segment = F.col("c_name"), F.col("c_mktsegment")
        return c.select(
            key.alias("customer_id"),
            F.when(key % 11 == 5, F.lit(None).cast("string")).otherwise(segment).alias("first_name"),
            F.when(key % 3 == 0, F.substring(name, 1, 4))
            .when(key % 3 == 1, name)
            .otherwise(F.concat(name, segment))
            .alias("last_name"),
            F.when(key % 7 == 2, F.lit(None).cast("bigint"))
            .otherwise(F.col("c_nationkey").cast("bigint"))
            .alias("customer_city"),
            F.when(key % 13 == 4, F.lit(None).cast("bigint"))
            .when(key % 5 == 0, F.lit(900000000) + key)
            .otherwise(F.lit(10000000000) + key)
            .alias("cpf"),
            F.when(key % 4 == 0, " Brazil ")
            .when(key % 4 == 1, "Brasil")
            .when(key % 4 == 2, "Mexico")
            .alias("country_name"),
        )

    # -- pix_movements <- orders -------------------------------------------------
    def _build_pix_movements(self) -> DataFrame:
        o = self.driver("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
        key = F.col("o_orderkey")
        pending = F.col("o_orderstatus") == "P"
        amount = (
            F.when(key % 23 == 1, F.lit(Decimal("50.00")))
            .when(key % 23 == 2, F.lit(Decimal("0.00")))
            .when(key % 23 == 3, F.lit(Decimal("1500000.00")))
            .otherwise(F.col("o_totalprice").cast(DECIMAL))
        )
        return o.select(
            key.alias("id"),
            _transaction_account(F.col("o_custkey")).alias("account_id"),
            amount.cast(DECIMAL).alias("pix_amount"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("pix_requested_at"),
            F.when(pending, F.lit(None).cast("timestamp_ntz"))
            .otherwise(F.col("o_orderdate").cast("timestamp_ntz"))
            .alias("pix_completed_at"),
            F.when(pending, "failed").otherwise("completed").alias("status"),
            F.when(key % 17 == 0, "pix_other").when(key % 2 == 0, "pix_in").otherwise(" PIX_OUT ").alias("in_or_out"),
        )

    # -- transfers <- lineitem join orders ---------------------------------------
    @property
    def transfers(self) -> DataFrame:
        """Both transfer feeds in one pass: the raw columns plus ``feed`` ('in' / 'out').

        Every line item is in exactly one feed: returned lines by their flag ('A' in, 'R' out), all others by the parity
        of the line number. One large-large equi join on the order key, left to the planner (sort-merge; AQE may switch
        sides or split skew); both sides are pruned at the scan first.
        """
        if "transfers" not in self._cache:
            li = self.driver("lineitem").select(
                "l_orderkey", "l_linenumber", "l_extendedprice", "l_linestatus", "l_shipdate", "l_returnflag"
            )
            o = self.driver("orders").select("o_orderkey", "o_custkey", "o_orderdate")
            j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
            shipped, flag = F.col("l_linestatus") == "F", F.col("l_returnflag")
            by_parity = F.when(F.col("l_linenumber") % 2 == 0, "in").otherwise("out")
            self._cache["transfers"] = j.select(
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("id"),
                _transaction_account(F.col("o_custkey")).cast("bigint").alias("account_id"),
                F.col("l_extendedprice").cast(DECIMAL).alias("amount"),
                ts_to_epoch(F.col("o_orderdate")).cast("string").alias("transaction_requested_at"),
                F.when(shipped, ts_to_epoch(F.col("l_shipdate")).cast("string"))
                .otherwise("None")
                .alias("transaction_completed_at"),
                F.when(shipped, "completed").otherwise("pending").alias("status"),
                F.when(flag == "A", "in").when(flag == "R", "out").otherwise(by_parity).alias("feed"),
            )
        return self._cache["transfers"]

    def _build_transfer_ins(self) -> DataFrame:
        return self.transfers.where("feed = 'in'").drop("feed")

    def _build_transfer_outs(self) -> DataFrame:
        return self.transfers.where("feed = 'out'").drop("feed")

    # -- location <- nation / region / fixed country list -------------------------
    def _build_city(self) -> DataFrame:
        n = self.driver("nation").select("n_nationkey", "n_name", "n_regionkey")
        return n.select(
            F.col("n_name").alias("city_name"),
            F.when(F.col("n_nationkey") == 24, F.lit(99)).otherwise(F.col("n_regionkey")).cast("bigint").alias("state_id"),
            F.col("n_nationkey").cast("bigint").alias("city_id"),
        )

    def _build_state(self) -> DataFrame:
        r = self.driver("region").select("r_regionkey", "r_name")
        return r.select(
            F.col("r_name").alias("state"),
            (F.col("r_regionkey") + 1).cast("int").alias("country_id"),
            F.col("r_regionkey").cast("int").alias("state_id"),
        )

    def _build_country(self) -> DataFrame:
        # country_id = region key + 1, the id each state points at; regions beyond
        # the named list get a NULL name (they still exist as countries).
        r = self.driver("region").select("r_regionkey")
        cid = F.col("r_regionkey") + 1
        names = F.array(*[F.lit(n) for n in COUNTRY_NAMES])
        return r.select(
            F.when(cid <= len(COUNTRY_NAMES), F.element_at(names, cid.cast("int"))).alias("country"),
            cid.cast("bigint").alias("country_id"),
        )

    # -- calendar <- the years spanned by the transaction dates -------------------
    def calendar_bounds(self) -> tuple[dt.date, dt.date]:
        """First and last day of the calendar: Jan 1 of the first and Dec 31 of the
        last year with an order or shipment date.

        One aggregate job over the two date columns; only the two dates reach the
        driver. Every calendar table is then generated from them, so no lookup
        re-scans the facts.
        """
        if "_bounds" not in self._cache:
            dates = (
                self.driver("orders").select(F.col("o_orderdate").cast("date").alias("d"))
                .unionByName(self.driver("lineitem").select(F.col("l_shipdate").cast("date").alias("d")))
            )
            row = dates.agg(F.min("d").alias("lo"), F.max("d").alias("hi")).first()
            lo, hi = (row["lo"], row["hi"]) if row["lo"] is not None else (dt.date.today(), dt.date.today())
            self._cache["_bounds"] = (dt.date(lo.year, 1, 1), dt.date(hi.year, 12, 31))
        return self._cache["_bounds"]

    def calendar_days(self) -> DataFrame:
        """One row per calendar day, generated in Spark from the bounds."""
        lo, hi = self.calendar_bounds()
        return self.spark.range(1).select(F.explode(day_sequence(F.lit(lo), F.lit(hi))).alias("d"))

    def _build_d_time(self) -> DataFrame:
        d, number = F.col("d"), F.unix_date("d")
        day_id = (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")
        hours = F.when(number % DOUBLE_DAY[0] == DOUBLE_DAY[1], F.array(F.lit(0), F.lit(12))).otherwise(F.array(F.lit(0)))
        days = self.calendar_days().where(number % MISSING_DAY[0] != MISSING_DAY[1]).select("d", F.explode(hours).alias("hour"))
        good = days.select(
            F.when(F.col("hour") == 0, day_id).otherwise(day_id * 100 + F.col("hour")).alias("time_id"),
            F.concat(d.cast("string"), F.format_string(" %02d:00:00", "hour")).alias("action_timestamp"),
            F.weekofyear(d).alias("week_id"),
            F.month(d).alias("month_id"),
            F.year(d).alias("year_id"),
            (F.weekday(d) + 1).alias("weekday_id"),
        )
        # One unparseable row, as a raw feed would carry; staging must drop it.
        bad = self.spark.range(1).select(
            F.lit(MALFORMED_TIME_ID).cast("bigint").alias("time_id"),
            F.lit("None").alias("action_timestamp"),
            F.lit(1).alias("week_id"),
            F.lit(1).alias("month_id"),
            F.lit(self.calendar_bounds()[0].year).alias("year_id"),
            F.lit(1).alias("weekday_id"),
        )
        return good.unionByName(bad)

    def _lookup(self, key_expr, value_expr, key: str, value: str) -> DataFrame:
        return self.calendar_days().select(key_expr.alias(key), value_expr.alias(value)).distinct()

    def _build_d_week(self) -> DataFrame:
        return self._lookup(F.weekofyear("d"), F.weekofyear("d"), "week_id", "action_week")

    def _build_d_month(self) -> DataFrame:
        return self._lookup(F.month("d"), F.month("d").cast("bigint"), "month_id", "action_month")

    def _build_d_year(self) -> DataFrame:
        return self._lookup(F.year("d"), F.year("d"), "year_id", "action_year")

    def _build_d_weekday(self) -> DataFrame:
        return self._lookup(F.weekday("d") + 1, F.date_format("d", "EEEE"), "weekday_id", "action_weekday")
