"""Ranks and running totals over a whole frame, without a window in one task.

Rows are dealt into ranges of their order, each range numbers or sums its own
rows, and a range's offset is the total of the ranges before it. The offsets are
one row a range, so the only window without partitions is over that many rows.
The ranges are written once: both the local pass and the totals read the same.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

RANGE, OFFSET = "__range", "__offset"


def ranged(df: DataFrame, order: Sequence[Column], ranges: int | None = None) -> DataFrame:
    """``df`` in ranges of ``order``, numbered by ``__range``; written and read again.

    ``order`` must be unique to keep the ranges even: equal rows can't be parted.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, f"ranged/{uuid.uuid4().hex}")
    rows = df.repartitionByRange(n, *order).withColumn(RANGE, F.spark_partition_id())
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _offsets(totals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each range's offset from ``__total``, one row a range (and member of ``by``)."""
    before = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(OFFSET, F.coalesce(F.sum("__total").over(before), F.lit(0))).drop("__total")


def prefix_sum(df: DataFrame, order: Sequence[str], value: str, name: str, by: Sequence[str] = (),
               ranges: int | None = None) -> DataFrame:
    """``df`` with the running total ``name`` of ``value`` in ``order``, for each member of ``by``.

    A member with a third of all rows lies in many ranges like any other rows.
    """
    by = list(by)
    rows = ranged(df, [F.col(c) for c in (*by, *order)], ranges)
    local = F.sum(value).over(Window.partitionBy(RANGE, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    offsets = _offsets(rows.groupBy(RANGE, *by).agg(F.sum(value).alias("__total")), by)
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    offsets = offsets.withColumnsRenamed({RANGE: "__of", **{c: f"__{c}" for c in by}})
    out = rows.withColumn(name, local).join(offsets, reduce(Column.__and__, same, F.col(RANGE) == F.col("__of")))
    return out.withColumn(name, F.col(name) + F.col(OFFSET)).select(*df.columns, name)


def dense_rank(df: DataFrame, order: Sequence[tuple[str, bool]], name: str, ranges: int | None = None) -> DataFrame:
    """``df`` with the dense rank ``name`` by ``order`` (column, descending); nulls come last.

    Only distinct keys are ranked; rows get their key's rank by a join, in
    which a key that most rows share is split like any skewed key.
    """
    cols = [c for c, _ in order]
    by = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in order]
    keys = ranged(df.select(*cols).distinct(), by, ranges)
    offsets = _offsets(keys.groupBy(RANGE).agg(F.count(F.lit(1)).alias("__total")))
    ranks = (keys.withColumn("__local", F.row_number().over(Window.partitionBy(RANGE).orderBy(*by)))
             .join(offsets, RANGE).select(*[F.col(c).alias(f"__{c}") for c in cols],
                                          (F.col("__local") + F.col(OFFSET)).cast("bigint").alias(name)))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in cols])
    return df.join(ranks, same).select(*df.columns, name)


def backlog(opened: DataFrame, closed: DataFrame, day: str = "day", by: Sequence[str] = ()) -> DataFrame:
    """E5: (by, day, opened, closed, open): what is open at each day's end, from one row per opening and closing.

    A sweep of +1 and -1: only days with a change have rows, and a closing without a day never comes.
    """
    one, none = F.lit(1), F.lit(0)
    events = (opened.select(*by, F.col(day), one.alias("o"), none.alias("c"))
              .unionByName(closed.select(*by, F.col(day), none.alias("o"), one.alias("c"))).where(F.col(day).isNotNull()))
    days = events.groupBy(*by, day).agg(F.sum("o").alias("opened"), F.sum("c").alias("closed"))
    days = days.withColumn("__net", F.col("opened") - F.col("closed"))
    return prefix_sum(days, [day], "__net", "open", by).drop("__net")
