"""SimHash near-duplicates by the general pigeonhole principle.

Fingerprints within ``max_bits`` differing bits are linked; linked documents form
components. The 64 bits are cut into partitions of correlated bits. Partition i
gets a threshold t_i >= -1 with sum(t_i) = max_bits - m + 1; then every linked
pair agrees in some partition up to t_i bits, so probing each partition within
its radius finds every link, and a partition with t_i = -1 isn't probed at all. A
dynamic program picks the thresholds of least estimated work; the estimates come
from a bounded sample of fingerprints and never change the result. The number of
partitions (3 to 5 for 4 bits) is picked by the same estimate, so keys get longer
as the corpus grows. Candidates are verified inside the join.

Only distinct fingerprints are joined: exact copies meet in a partial
aggregation. A bucket of more than ``hot_bucket`` fingerprints is split again by
the plain pigeonhole over a second cut of the bits, exactly.

Defined cases: a null text is an empty text; a text without words has
fingerprint 0; fewer than ``shingle`` words make one shingle; an empty table
gives an empty result; repeated rows get the same component; a null id never
becomes a component's id unless the component has no other; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import is_bounded
from .common import materialise

SHINGLE, MAX_BITS, SEED = 4, 4, 42
SAMPLE = 4000                 # fingerprints that the cost estimates are made on
HOT_BUCKET = 4096
PROBE_COST, PAIR_COST = 40.0, 1.0


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text, as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # A-Z and ASCII white space only
    if not words:
        return 0
    data = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    first = [0, *(ends[:-1] + 1).tolist()]
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):                      # bounded memory for any length
        block = np.array([digest(data[a:b], seed) for a, b in zip(first[at:at + 65536], last[at:at + 65536])], "<u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 seed: int = SEED) -> DataFrame:
    """(id, fp): the fingerprint of every whole text, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), shingle, seed) for t in batch.column("text")], "<u8")
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fp.view("<i8"))], ["id", "fp"])

    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return base.mapInArrow(run, f"id {base.schema['id'].dataType.simpleString()}, fp bigint")


# --- the cut: correlated bits together, thresholds by dynamic programming ---------------------

def partitions(sample: np.ndarray, m: int) -> list[list[int]]:
    """``m`` groups of nearly equal width; each is grown from the strongest correlations left."""
    bits = ((sample[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(float)
    bits -= bits.mean(0) if len(sample) else 0
    scale = np.sqrt((bits ** 2).sum(0)) + 1e-9
    related = np.abs(bits.T @ bits / np.outer(scale, scale))
    np.fill_diagonal(related, 0)
    left, out = list(range(64)), []
    for i in range(m):
        width = len(left) // (m - i)
        group = [max(left, key=lambda b: (related[b, left].sum(), -b))]
        while len(group) < width:
            group.append(max((b for b in left if b not in group), key=lambda b: (related[b, group].sum(), -b)))
        left = [b for b in left if b not in group]
        out.append(sorted(group))
    return out


def mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def near_share(sample: np.ndarray, bits: list[int], t: int) -> float:
    """Estimated share of pairs that differ in at most ``t`` of these bits."""
    if t < 0:
        return 0.0
    chance = sum(comb(len(bits), k) for k in range(t + 1)) / 2.0 ** len(bits)
    x = sample & np.uint64(mask(bits))
    a, b = x[: len(x) // 2], x[len(x) // 2:]
    seen = sum(int((np.bitwise_count(a ^ np.roll(b, k)[: len(a)]) <= t).sum()) for k in range(min(200, len(b))))
    return max(chance, seen / max(1, len(a) * min(200, len(b))))


def allocate(sample: np.ndarray, groups: list[list[int]], max_bits: int, n: int) -> tuple[float, list[int]]:
    """(estimated work, thresholds): dynamic program over the partitions, by threshold sum."""
    m = len(groups)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for bits in groups:
        work = {}
        for t in range(-1, max_bits + 1):
            probes = sum(comb(len(bits), k) for k in range(t + 1))
            if probes > 3000:
                break
            work[t] = n * (probes + (t >= 0)) * PROBE_COST + n * n / 2 * near_share(sample, bits, t) * PAIR_COST
        grown: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, picks) in best.items():
            for t, w in work.items():
                if total + t not in grown or cost + w < grown[total + t][0]:
                    grown[total + t] = (cost + w, [*picks, t])
        best = grown
    return best.get(max_bits - m + 1, (float("inf"), []))


def plan(sample: np.ndarray, max_bits: int, n: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each probed partition: the cut of least estimated work."""
    best = (float("inf"), [])
    for m in range(max(1, (max_bits + 2) // 2), max_bits + 2):
        groups = partitions(sample, m)
        cost, picks = allocate(sample, groups, max_bits, n)
        if cost < best[0]:
            best = (cost, [(g, t) for g, t in zip(groups, picks) if t >= 0])
    return best[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _differ(bits: list[int]) -> Column:
    both = F.col("fp").bitwiseXOR(F.col("other")).bitwiseAND(F.lit(_signed(mask(bits))))
    return F.bit_count(both)


def links(spark: SparkSession, nodes: DataFrame, max_bits: int = MAX_BITS, hot_bucket: int = HOT_BUCKET,
          sample_rows: int = SAMPLE) -> DataFrame:
    """(fp, other) with fp < other: every linked pair of the distinct fingerprints in ``nodes``, once."""
    n = nodes.count()
    rows = nodes.select("fp").orderBy(F.xxhash64("fp")).limit(sample_rows).collect()
    sample = np.array([r.fp for r in rows], "<i8").view("<u8")
    cut = plan(sample, max_bits, n)
    key = lambda bits: F.col("fp").bitwiseAND(F.lit(_signed(mask(bits))))
    data = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), key(bits).alias("key")) for i, (bits, _) in enumerate(cut)])).alias("k"))
    data = data.select("fp", "k.part", "k.key")

    def probes(part: int, bits: list[int], t: int) -> Column:
        flips = [_signed(mask(list(c))) for k in range(t + 1) for c in combinations(bits, k)]
        return F.transform(F.array(*[F.lit(x) for x in flips]), lambda x: F.struct(
            F.lit(part).alias("part"), key(bits).bitwiseXOR(x).alias("key")))

    query = nodes.select(F.col("fp").alias("other"), F.explode(F.concat(*[
        probes(i, bits, t) for i, (bits, t) in enumerate(cut)])).alias("k")).select("other", "k.part", "k.key")
    # the first partition in which a pair is near reports it, so that each link is made once
    first = F.lit(False)
    for i in range(len(cut)):
        earlier = F.lit(True)
        for bits, t in cut[:i]:
            earlier = earlier & (_differ(bits) > t)
        first = first | ((F.col("part") == i) & earlier)
    linked = (F.col("fp") < F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits)

    hot = data.groupBy("part", "key").count().where(F.col("count") > hot_bucket).select("part", "key")
    hot = materialise(spark, hot, "simhash-hot")
    if hot.isEmpty():
        return _joined(data, query, ["part", "key"], linked & first)
    # Within a hot bucket, a second cut: of max_bits + 1 groups of bits, one is equal in both.
    second = [list(range(j, 64, max_bits + 1)) for j in range(max_bits + 1)]
    first_second = F.lit(False)
    for j in range(len(second)):
        earlier = F.lit(True)
        for bits in second[:j]:
            earlier = earlier & (_differ(bits) > 0)
        first_second = first_second | ((F.col("sub") == j) & earlier)

    def refined(df: DataFrame, fp: str) -> DataFrame:
        subs = F.array(*[F.struct(F.lit(j).alias("sub"), F.col(fp).bitwiseAND(F.lit(_signed(mask(b)))).alias("subkey"))
                         for j, b in enumerate(second)])
        return (df.join(hot, ["part", "key"], "left_semi").withColumn("s", F.explode(subs))
                .select(fp, "part", "key", "s.sub", "s.subkey"))

    cold = [df.join(hot, ["part", "key"], "left_anti") for df in (data, query)]
    return _joined(*cold, ["part", "key"], linked & first).unionByName(
        _joined(refined(data, "fp"), refined(query, "other"), ["part", "key", "sub", "subkey"],
                linked & first & first_second))


def _joined(data: DataFrame, query: DataFrame, keys: list[str], condition: Column) -> DataFrame:
    """Equi-join whose extra condition drops a candidate before it becomes a row."""
    right = query.select("other", *[F.col(k).alias(f"q_{k}") for k in keys])
    for k in keys:
        condition = (F.col(k) == F.col(f"q_{k}")) & condition
    return data.join(right, condition).select("fp", "other")


# --- components -------------------------------------------------------------------------------

def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges (a, b) with the least node reachable from it.

    Alternating large-star and small-star steps: each points nodes at the least
    neighbour known, until every node points at its root. Each step is a grouped
    minimum and a join back; the edges never gather in one place.
    """
    a, b = edges.columns
    stars = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    stars, seen = materialise(spark, stars, "cc"), None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        stars = materialise(spark, small, "cc")
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return (stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())


def dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          shingle: int = SHINGLE, max_bits: int = MAX_BITS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """(id, fp, component): every row with the least id reachable over links, its own included."""
    return _labelled(spark, docs, id_col, text_col, shingle, max_bits, hot_bucket).drop("root")


def _labelled(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int,
              hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """As ``dedup``, with ``root``, the component's least fingerprint: components of repeated ids share an id."""
    fps = materialise(spark, fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    nodes = materialise(spark, fps.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    edges = links(spark, nodes, max_bits, hot_bucket)
    roots = components(spark, edges)
    # the root is the component's least fingerprint; its id is the least one of any member
    named = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least")
    named = materialise(spark, named, "simhash-named")
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    label = named.join(least, "root").select(F.col("fp").alias("node"), "root", "component")
    return fps.join(label, fps.fp == label.node).select(F.col("id").alias(id_col), "fp", "root", "component")


def keep_one(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows, with all their columns, of each component's least id.

    Where several rows of a component have that id, the one of the least fingerprint and text
    hash stays; rows of one id in different components are judged apart. Rows without an id
    can't be named and stay.
    """
    found = materialise(spark, _labelled(spark, docs, id_col, text_col, shingle, max_bits), "simhash-found")
    repeated = found.groupBy(id_col).count().where(f"count > 1 and `{id_col}` is not null").select(id_col)
    repeated = materialise(spark, repeated, "simhash-repeated")
    gone = found.where(F.col(id_col) != F.col("component")).select(id_col)
    gone = materialise(spark, gone.unionByName(repeated).distinct(), "simhash-gone")
    # ids within the checked broadcast bound leave the texts where they are; more ids shuffle them
    kept = docs.join(F.broadcast(gone) if is_bounded(gone) else gone, id_col, "left_anti")
    if repeated.isEmpty():
        return kept

    @F.arrow_udf("bigint")
    def fp(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py(), shingle) for t in texts], "<u8").view("<i8"))

    least = (found.where(F.col(id_col) == F.col("component")).join(repeated, id_col, "left_semi")
             .select(F.col(id_col).alias("__id"), F.col("fp").alias("__of"), F.col("root").alias("__root")).distinct())
    rows = docs.join(repeated, id_col, "left_semi").withColumn("__fp", fp(F.col(text_col)))
    rows = rows.join(least, (F.col(id_col) == F.col("__id")) & (F.col("__fp") == F.col("__of")))
    order = F.struct("__fp", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256), F.to_json(F.struct(*docs.columns)))
    one = rows.groupBy("__id", "__root").agg(F.min_by(F.struct(*docs.columns), order).alias("row"))
    return kept.unionByName(one.select("row.*"))
