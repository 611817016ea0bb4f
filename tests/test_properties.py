"""Property tests: exact HALF_UP rounding agrees with Python's Decimal."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from quartermaster.functions import expr as X


def _half_up(n, d, scale, digits):
    if d == 0:
        return None
    q = (Decimal(n) * scale / Decimal(d)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)
    return float(q)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(0, 10**6)), min_size=1, max_size=200),
       st.sampled_from([1, 100]), st.integers(0, 3))
def test_ratio_matches_decimal(spark, pairs, scale, digits):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r.v for r in df.select(X.ratio("n", "d", scale, digits).alias("v")).collect()]
    assert got == [_half_up(n, d, scale, digits) for n, d in pairs]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**6)), min_size=1, max_size=200),
       st.integers(0, 2))
def test_avg_exact_matches_decimal(spark, pairs, digits):
    df = spark.createDataFrame(pairs, "s long, n long")
    got = [r.v for r in df.select(X.avg_exact("s", "n", digits).alias("v")).collect()]
    assert got == [_half_up(s, n, 1, digits) for s, n in pairs]
