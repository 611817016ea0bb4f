"""Result-shaping operators: top-N, month-over-month, drivers, ranking, counters.

All of them run on already-aggregated frames. None uses an un-partitioned
window: totals are scalar subqueries, the previous month comes from a join on
``add_months`` - so no step gathers a whole frame into one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows by ``order`` (planned as TakeOrderedAndProject:
    a per-partition top-n, then a merge of n rows per partition).

    ``order`` must end in a unique tie-break (T7) for a deterministic answer.
    """
    return df.orderBy(*order).limit(n)


def mom_change(monthly: DataFrame, month: str, value: str, digits: int = 1) -> DataFrame:
    """Value, previous calendar month's value, change and % change.

    ``value`` is an exact decimal. The previous month is found by joining on
    ``add_months(month, 1)`` rather than ``lag`` over an un-partitioned window: a
    gap month yields NULL (not the value of an older month) and no single task
    holds the whole series.
    """
    prev = monthly.select(
        F.add_months(F.col(month), 1).alias("__next"),
        F.col(value).alias("__prev"))
    out = monthly.join(prev, F.col(month) == F.col("__next"), "left").drop("__next")
    cur, old = F.col(value), F.col("__prev")
    return out.select(
        *[cc for cc in monthly.columns if cc != value],
        X.money_out(cur).alias(value),
        X.money_out(old).alias("prev_" + value),
        X.money_out(cur - old).alias("mom_change"),
        X.ratio_dec((cur - old) * 100, old, digits).alias("mom_pct"))


def share_exact(df: DataFrame, value: str, name: str, digits: int = 4) -> DataFrame:
    """``value / sum(value)`` over the whole frame, HALF_UP at ``digits``.

    The total is an uncorrelated scalar subquery (one partial-then-final
    aggregate), not a window without PARTITION BY.
    """
    total = df.agg(F.sum(F.col(value))).scalar()
    q = F.try_divide(F.col(value).cast("decimal(38,18)"), total.cast("decimal(38,2)"))
    return df.withColumn(name, F.round(q, digits).cast("double"))


def drivers(agg: DataFrame, by: Sequence[str], base: str, compare: str,
            base_months: int = 1, compare_months: int = 1,
            normalise: str = "per_month") -> DataFrame:
    """V1: break the change between two windows down by ``by``.

    ``agg`` holds one row per group with the exact (DECIMAL) totals of the base
    and compare windows (columns ``base`` and ``compare``; NULL = no rows).
    ``delta_spend`` is the change per month (``normalise='per_month'``) or in
    total; ``share_of_change`` is each group's part of the summed change.
    """
    bm, cm = (base_months, compare_months) if normalise == "per_month" else (1, 1)
    b = F.coalesce(F.col(base), F.lit(0).cast("decimal(38,2)"))
    cc = F.coalesce(F.col(compare), F.lit(0).cast("decimal(38,2)"))
    d = agg.withColumn("__b", b).withColumn("__c", cc).withColumn("__d", cc * bm - b * cm)
    d = share_exact(d, "__d", "share_of_change")
    return d.select(*by,
                    X.money_out("__b").alias("base_spend"),
                    X.money_out("__c").alias("compare_spend"),
                    F.round(F.try_divide(F.col("__d").cast("decimal(38,18)"),
                                         F.lit(bm * cm).cast("decimal(38,0)")), 2)
                    .cast("double").alias("delta_spend"),
                    "share_of_change")


def rank_suppliers(df: DataFrame, rate: str = "on_time_pct", rating: str = "reliability_rating",
                   name: str = "supplier_name", best: bool = True) -> DataFrame:
    """Lexicographic order by on-time rate then rating (then name).

    A distributed sort (range-partitioned), not a rank window over one task.
    """
    if best:
        return df.orderBy(F.col(rate).desc_nulls_last(), F.col(rating).desc_nulls_last(), F.col(name))
    return df.orderBy(F.col(rate).asc_nulls_last(), F.col(rating).asc_nulls_last(), F.col(name))
