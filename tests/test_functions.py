import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.decimals import div_half_up
from ledgerline.functions.timeparse import month_sequence, parse_ts, with_parsed_ts


def _exact(num, den, scale, times=1):
    q = Decimal(times) * Decimal(num) / Decimal(den)
    return q.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)


def test_div_half_up_matches_decimal(spark):
    rnd = random.Random(7)
    rows = [(Decimal(rnd.randint(-10**9, 10**9)) / 100, Decimal(rnd.choice([1, -1]) * rnd.randint(1, 10**7)) / 100) for _ in range(300)]
    # exact ties at the rounding digit, both signs
    rows += [(Decimal("1.005"), Decimal("1.00")), (Decimal("-1.005"), Decimal("1.00")), (Decimal("0.125"), Decimal("0.01"))]
    df = spark.createDataFrame(rows, "n decimal(18,3), d decimal(18,2)")
    got = df.select("n", "d", div_half_up(F.col("n"), F.col("d"), 2, num_scale=3, den_scale=2).alias("q")).collect()
    for r in got:
        assert r["q"] == _exact(r["n"], r["d"], 2), (r["n"], r["d"], r["q"])


def test_div_half_up_percent_of_counts(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (5, 7), (0, 4)], "a long, b long")
    got = {(r.a, r.b): r.p for r in df.select("a", "b", div_half_up(F.col("a"), F.col("b"), 2, times=100).alias("p")).collect()}
    assert got[(1, 3)] == Decimal("33.33")
    assert got[(2, 3)] == Decimal("66.67")
    assert got[(1, 8)] == Decimal("12.50")
    assert got[(5, 7)] == Decimal("71.43")
    assert got[(0, 4)] == Decimal("0.00")


def test_parse_ts_epoch_iso_and_garbage(spark):
    df = spark.createDataFrame([("0",), ("946684800",), ("2001-02-03 04:05:06",), ("2001-02-03",), ("None",), (None,), (" 60 ",)], "s string")
    got = [r.t for r in df.select(parse_ts(F.col("s")).alias("t")).collect()]
    assert got == [
        dt.datetime(1970, 1, 1), dt.datetime(2000, 1, 1), dt.datetime(2001, 2, 3, 4, 5, 6), dt.datetime(2001, 2, 3),
        None, None, dt.datetime(1970, 1, 1, 0, 1),
    ]


def test_month_sequence_bounds(spark):
    df = spark.createDataFrame(
        [(dt.date(2020, 1, 1), dt.date(2020, 3, 31)), (dt.date(2020, 1, 15), dt.date(2020, 3, 1)), (dt.date(2020, 5, 1), dt.date(2020, 4, 30))],
        "lo date, hi date",
    )
    got = [r.m for r in df.select(month_sequence(F.col("lo"), F.col("hi")).alias("m")).collect()]
    assert got[0] == [dt.date(2020, 1, 1), dt.date(2020, 2, 1), dt.date(2020, 3, 1)]
    assert got[1] == [dt.date(2020, 2, 1), dt.date(2020, 3, 1)]  # month start must be >= lo
    assert got[2] == []


def test_epoch_conversions_ignore_session_time_zone(spark):
    """Brazilian daylight-saving switches at local midnight must not shift UTC values."""
    from ledgerline.functions.timeparse import epoch_to_ts, ts_to_epoch

    seconds = [0, 876096000, 876099600, 940723200, 951868799, 1577836800, -86401]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ["UTC", "America/Sao_Paulo", "Asia/Tokyo"]:
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = spark.createDataFrame([(s,) for s in seconds], "s long")
            got = df.select("s", epoch_to_ts(F.col("s")).alias("t")).select("s", "t", ts_to_epoch(F.col("t")).alias("back")).collect()
            for r in got:
                assert r.t == dt.datetime(1970, 1, 1) + dt.timedelta(seconds=r.s), (tz, r)
                assert r.back == r.s, (tz, r)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_parse_ts_auto_scale(spark):
    df = spark.createDataFrame([("946684800",), ("946684800123",), ("946684800123456",), ("946684800123456789",)], "s string")
    got = [r.t for r in df.select(parse_ts(F.col("s"), auto_scale=True).alias("t")).collect()]
    base = dt.datetime(2000, 1, 1)
    assert got == [base, base + dt.timedelta(milliseconds=123), base + dt.timedelta(microseconds=123456), base + dt.timedelta(microseconds=123456)]


def test_with_parsed_ts_equals_the_expression(spark):
    """Both forms agree on every kind of text, in every session time zone; other columns and their order stay."""
    texts = ["0", " 60 ", "-1", "946684800", "946684800.123456", "1.", "-0.5", "253402300799.999999", "253402300800", "-62135596800.5", "2001-02-03", "2001-02-03 04:05:06.5",
             "1577836800000", "20200102030405", "9" * 31, "1e9", "None", "", "x", None, "1997-10-05 23:30:00"]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(i, s, s, 1) for i, s in enumerate(texts)], "i int, s string, kept string, last int")
            for scale in (False, True):
                both = with_parsed_ts(df, "s", scale).withColumn("e", parse_ts(F.col("kept"), auto_scale=scale))
                assert both.columns == ["i", "s", "kept", "last", "e"]
                rows = both.collect()
                assert len(rows) == len(texts) and all(r.s == r.e for r in rows)
                got = {r.kept: r.s for r in rows}
                assert got["946684800.123456"] == dt.datetime(2000, 1, 1, 0, 0, 0, 123456) and got["1997-10-05 23:30:00"] == dt.datetime(1997, 10, 5, 23, 30)
                assert got["9" * 31] is None and got["-0.5"] == dt.datetime(1969, 12, 31, 23, 59, 59, 500000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    timed = spark.createDataFrame([(dt.datetime(2020, 1, 1),)], "t timestamp_ntz")
    assert with_parsed_ts(timed, "t").collect() == timed.collect()


def test_parse_ts_never_raises(spark):
    """Every text is a value or NULL, in both modes; numbers out of range are NULL."""
    texts = ["1577836800000", "20200102030405", "99999999999999", "1" + "0" * 18, "9" * 30, "-9223372036854775808", "9223372036854775807",
             "1577836800.25", "-1.5", "1e9", "+60", "20200102", "2020-13-01", "20201301000000", "", " ", "abc", "١٢٣", "1.", "0.0000001", "-62135596800", "253402300799", "253402300800"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    plain = dict(df.select("s", parse_ts(F.col("s")).alias("t")).collect())
    scaled = dict(df.select("s", parse_ts(F.col("s"), auto_scale=True).alias("t")).collect())
    new_year = dt.datetime(2020, 1, 1)
    assert plain["1577836800000"] is None and scaled["1577836800000"] == new_year
    assert plain["20200102030405"] is None and scaled["20200102030405"] == dt.datetime(2020, 1, 2, 3, 4, 5)
    assert plain["1577836800.25"] == new_year + dt.timedelta(milliseconds=250) and plain["+60"] == dt.datetime(1970, 1, 1, 0, 1)
    assert plain["-62135596800"] == dt.datetime(1, 1, 1) and plain["253402300799"] == dt.datetime(9999, 12, 31, 23, 59, 59)
    for bad in ("253402300800", "9" * 30, "2020-13-01", "", "abc", "-9223372036854775808", "99999999999999"):
        assert plain[bad] is None, bad
    for bad in ("9" * 30, "2020-13-01", "", "abc"):
        assert scaled[bad] is None, bad
    n = spark.createDataFrame([(946684800,), (2**63 - 1,), (-(2**63),), (None,)], "n long").select(parse_ts(F.col("n"), T.LongType()).alias("t"))
    assert [r.t for r in n.collect()] == [dt.datetime(2000, 1, 1), None, None, None]
