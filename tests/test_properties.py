"""Property test: the exact ratio helper equals Python's Decimal half-up rounding."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions.decimals import div_half_up

cents = st.integers(min_value=-10**15, max_value=10**15)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(cents, cents.filter(lambda v: v != 0), st.integers(0, 10), st.sampled_from([1, 100])), min_size=1, max_size=60))
def test_div_half_up_is_exact(spark, rows):
    data = [(Decimal(n) / 100, Decimal(d) / 100, s, t) for n, d, s, t in rows]
    df = spark.createDataFrame([(n, d) for n, d, _, _ in data], "n decimal(18,2), d decimal(18,2)")
    for scale in sorted({s for _, _, s, _ in data}):
        for times in (1, 100):
            got = [r.q for r in df.select(div_half_up(F.col("n"), F.col("d"), scale, 2, 2, times).alias("q")).collect()]
            want = [(Decimal(times) * n / d).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP) for n, d, _, _ in data]
            assert got == want
