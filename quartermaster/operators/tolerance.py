"""E1 with a numeric tolerance: rows match one to one if their values differ by little.

Rows of both sides are counted by key and value, ordered and dealt into ranges.
Within a range a two-pointer merge walks the values of a key in order; the oldest
unmatched value is matched first, which finds as many pairs as there can be. What
is still unmatched and near at a range's end is handed to the next range, and the
ranges are merged again until nothing that is handed on changes: mostly two
rounds. A key with a third of all rows lies in as many ranges as its values need.
"""

from __future__ import annotations

import uuid
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .ordered import RANGE, ranged

KEY, VALUE, N_TRUTH, N_CANDIDATE = "__key", "__value", "__nt", "__nc"
OUT = f"kind string, {RANGE} int, {KEY} string, {VALUE} double, side string, n long"


def merged(rows: list[tuple], pending: list[tuple], tolerance: float, last: bool) -> Iterator[tuple]:
    """Unmatched counts ('left') of one range and what it hands on ('next'): (kind, key, value, side, n).

    ``rows`` are (key, value, truths, candidates) in order; ``pending`` is what the range before
    handed on, of its last key and of one side.
    """
    queue = deque([value, n] for _, value, _, n in pending)
    side = pending[0][2] if pending else ""
    key = pending[0][0] if pending else None

    def out(kind):
        while queue:
            value, n = queue.popleft()
            yield kind, key, value, side, n

    for k, value, nt, nc in rows:
        if k != key:
            yield from out("left")
            key = k
        while queue and queue[0][0] < value - tolerance:
            old, n = queue.popleft()
            yield "left", key, old, side, n
        have = {"missing": nt, "extra": nc}                 # truths wait as missing, candidates as extra
        other = "extra" if side == "missing" else "missing"
        while queue and have[other]:
            m = min(queue[0][1], have[other])
            queue[0][1] -= m
            have[other] -= m
            if not queue[0][1]:
                queue.popleft()
        m = min(have.values())
        for s in have:
            if have[s] - m:
                side = s
                queue.append([value, have[s] - m])
    yield from out("left" if last else "next")


def diff_within(truth: DataFrame, candidate: DataFrame, value: str, tolerance: float, digits: int = 6,
                ranges: int | None = None) -> DataFrame:
    """Rows without a partner: ``side`` ('missing' | 'extra'), the columns, and ``n``, how many.

    A pair agrees in every column but ``value``, where it differs by ``tolerance``
    at most; the number of pairs is the greatest possible. Other doubles are
    rounded to ``digits``. A null value agrees with a null, NaN with NaN.
    """
    spark = truth.sparkSession
    cols = [c for c in truth.columns if c != value]
    types = dict(truth.dtypes)
    exact = [F.round(c, digits).alias(c) if types[c] in ("double", "float") else F.col(c) for c in cols]

    def side(df: DataFrame, nt: int, nc: int) -> DataFrame:
        v = F.col(value).cast("double") + F.lit(0.0)                          # no negative nought
        key = F.to_json(F.struct(*exact), {"ignoreNullFields": "false"}) if cols else F.lit("{}")
        return df.select(key.alias(KEY), v.alias(VALUE), F.lit(nt).alias(N_TRUTH), F.lit(nc).alias(N_CANDIDATE))

    cells = (side(truth, 1, 0).unionByName(side(candidate, 0, 1)).groupBy(KEY, VALUE)
             .agg(F.sum(N_TRUTH).alias(N_TRUTH), F.sum(N_CANDIDATE).alias(N_CANDIDATE)))
    rows = ranged(cells, [F.col(KEY), F.col(VALUE)], ranges)
    numbers = rows.where(F.col(VALUE).isNotNull() & ~F.isnan(VALUE))
    # numbers of ranges, as many as partitions
    order = sorted(r[0] for r in numbers.select(RANGE).distinct().collect())
    after = dict(zip(order, order[1:]))
    handed, left = spark.createDataFrame([], OUT), spark.createDataFrame([], OUT)
    for _ in range(len(order)):
        got = _round(numbers, handed, tolerance, order[-1])
        path = scratch_path(spark, f"tolerance/{uuid.uuid4().hex}")
        got.write.partitionBy("kind").parquet(path)
        got = spark.read.schema(OUT).parquet(path)
        left = got.where("kind = 'left'")
        following = F.create_map(*[F.lit(x) for p in after.items() for x in p]) if after else F.lit(None)
        now = got.where("kind = 'next'").withColumn(RANGE, following[F.col(RANGE)] if after else F.col(RANGE)).select(*handed.columns)
        same = now.exceptAll(handed).isEmpty() and handed.exceptAll(now).isEmpty()
        handed = now
        if same:
            break
    odd = rows.where(F.col(VALUE).isNull() | F.isnan(VALUE)).select(
        KEY, VALUE, F.explode(F.array(
            F.struct(F.lit("missing").alias("side"), (F.col(N_TRUTH) - F.col(N_CANDIDATE)).alias("n")),
            F.struct(F.lit("extra").alias("side"), (F.col(N_CANDIDATE) - F.col(N_TRUTH)).alias("n")))).alias("x"))
    all_ = (left.select("side", KEY, VALUE, "n")
            .unionByName(odd.where("x.n > 0").select("x.side", KEY, VALUE, "x.n")))
    if not cols:
        return all_.select("side", F.col(VALUE).alias(value), "n")
    schema = ", ".join(f"`{c}` {types[c]}" for c in cols)
    return (all_.withColumn("__cols", F.from_json(KEY, schema))
            .select("side", *[F.col("__cols")[c].alias(c) for c in cols], F.col(VALUE).alias(value), "n"))


def _round(rows: DataFrame, handed: DataFrame, tolerance: float, end: int) -> DataFrame:
    """Every range merged once, with what the range before it handed on."""

    def merge(key: tuple, own: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values([KEY, VALUE], kind="stable")
        before = before.sort_values(VALUE, kind="stable")
        got = merged(list(zip(own[KEY], own[VALUE], own[N_TRUTH], own[N_CANDIDATE])),
                     list(zip(before[KEY], before[VALUE], before["side"], before["n"])), tolerance, key[0] == end)
        return pd.DataFrame([(kind, key[0], k, v, side, n) for kind, k, v, side, n in got],
                            columns=["kind", RANGE, KEY, VALUE, "side", "n"])

    return rows.groupBy(RANGE).cogroup(handed.groupBy(RANGE)).applyInPandas(merge, OUT)
