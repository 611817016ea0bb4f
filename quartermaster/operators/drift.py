"""How a column's distribution moves from month to month, from mergeable sketches.

Each month has one quantile sketch (KLL), a few kilobytes whatever its rows. Months
merge into quarters or years without the rows. The distance of two sketches is the
largest difference of their ranks over both sketches' quantiles, a
Kolmogorov-Smirnov distance off by the sketches' rank error at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import is_bounded

K = 400                       # a sketch of this size is off by less than RANK_ERROR in rank
RANK_ERROR = 0.01
PROBES = 100                  # quantiles of each sketch that are compared
DRIFT = 0.1


def sketches(df: DataFrame, period: Column, columns: Sequence[str], k: int = K) -> DataFrame:
    """(period, column, n, sketch): one row per period and column; nulls don't count."""
    aggs = [a for c in columns for a in (F.count(c).alias(f"n_{c}"), F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(f"s_{c}"))]
    wide = df.groupBy(period.alias("period")).agg(*aggs)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("n"), F.col(f"s_{c}").alias("sketch"))
                               for c in columns]))
    return wide.select("period", each.alias("x")).select("period", "x.*").where("n > 0")


def merged(of: DataFrame, period: Column, k: int = K) -> DataFrame:
    """Sketches of coarser periods, from finer ones alone."""
    return of.groupBy(period.alias("period"), "column").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def quantiles(sketch: Column, probes: int = PROBES) -> Column:
    """The values at the middles of ``probes`` equal shares of the rows, in order."""
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit((i + 0.5) / probes) for i in range(probes)]))


def distance(a: Column, b: Column, probes: int = PROBES) -> Column:
    """The largest difference in rank of two columns of ``quantiles``, off by 1 / ``probes`` besides the sketches' error."""
    def one_way(x: Column, y: Column) -> Column:
        # where x's i-th value stands among y's values; of equal values the nearest rank counts
        gaps = F.transform(x, lambda v, i: F.greatest(
            F.size(F.filter(y, lambda u: u < v)) - (i + 1), i - F.size(F.filter(y, lambda u: u <= v)), F.lit(0)) / probes)
        return F.array_max(gaps).cast("double")

    return F.greatest(one_way(a, b), one_way(b, a))


def drift(monthly: DataFrame, limit: float = DRIFT) -> DataFrame:
    """(column, period, n, distance, drifted): each month against the month before; a gap has no distance.

    A month is joined to its neighbour by date, so no window holds the whole series.
    """
    monthly = monthly.withColumn("q", quantiles(F.col("sketch")))
    before = monthly.select(F.add_months("period", 1).alias("period"), "column", F.col("q").alias("__before"))
    if is_bounded(before, max_rows=10_000):
        before = F.broadcast(before)          # periods times columns, each a few kilobytes
    out = monthly.join(before, ["period", "column"], "left")
    d = F.when(F.col("__before").isNotNull(), distance(F.col("__before"), F.col("q")))
    return (out.withColumn("distance", d).withColumn("drifted", F.coalesce(F.col("distance") > limit, F.lit(False)))
            .select("column", "period", "n", "distance", "drifted"))
