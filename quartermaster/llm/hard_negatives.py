"""Hard-negative mining over rotated one-bit codes.

Components become whole numbers. A row is rotated by a fixed random rotation and
its signs are its code; the row's alignment, its inner product with the unit
vector of the code, is stored with it, and so is the length of what the code
leaves over. ``LEVELS`` codes are taken one after another, each of the rest of
the one before, by a rotation of its own. An anchor's rotated components are cut
into ``PLANES`` bits, so the inner product of a code and the anchor is a weighted
sum of popcounts, off by a known amount at most. With the Cauchy-Schwarz bound on
the rest this gives an interval that is sure to hold the exact score. Rows whose
interval can't reach an anchor's present list are dropped, all others are
scored in whole numbers. The result is therefore exact.

Anchors are a stated query set (ids divisible by ``ANCHOR_EVERY``) and go to the
tasks in blocks of about ``BLOCK``, one pass over the codes for positives and one
for negatives each. A task keeps the best few rows of each anchor of the block; Spark
merges the tasks' lists. No rows are grouped by label, so a hot label costs nothing extra.

Defined cases: rows with a null id, label or vector, with an empty vector, or with
a component that is null, not finite or too large for a score of 64 bits take no part. Rows
of different dimensions are never partners. Rows that share an id are one item: its
best-scoring row counts, it is never its own partner, and the least row (label, then
bytes) is its anchor. Ties go to the smaller id. An empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise

ANCHOR_EVERY = 100
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90            # percent of the positive's score that a negative's lies between
SCALE = 256
LEVELS, PLANES = 4, 8
BLOCK = 4096                  # anchors of a pass
CELLS = 1 << 20               # pairs of a row and an anchor that are estimated at a time
SEED = 42
SLACK = 1e-6                  # of the product of lengths, for rounding in the estimates
CODED = "id long, label long, dim int, x binary, codes binary, align binary, rest double"


def rotations(dim: int, levels: int = LEVELS, seed: int = SEED) -> np.ndarray:
    """``levels`` random rotations."""
    rng = np.random.default_rng([seed, dim])
    return np.stack([np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(levels)])


def encode(x: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, levels, bytes), alignments (rows, levels) and the lengths of what is left over."""
    rest, dim = x.astype(float), x.shape[1]
    codes, align = [], []
    for turn in turns:
        o = rest @ turn.T
        up = o >= 0
        a = np.abs(o).sum(1) / np.sqrt(dim)
        codes.append(np.packbits(up, axis=1, bitorder="little"))
        align.append(a)
        rest = (o - np.where(up, 1.0, -1.0) * (a / np.sqrt(dim))[:, None]) @ turn
    return np.stack(codes, 1), np.stack(align, 1), np.linalg.norm(rest, axis=1)


def _words(codes: np.ndarray) -> np.ndarray:
    """Bytes to whole words of 64 bits along the last axis."""
    room = -codes.shape[-1] % 8
    codes = np.pad(codes, [(0, 0)] * (codes.ndim - 1) + [(0, room)])
    return np.ascontiguousarray(codes).view(np.uint64)


@dataclass(frozen=True)
class Queries:
    """Anchors of one dimension, ready for popcounts."""

    id: np.ndarray
    label: np.ndarray
    x: np.ndarray
    length: np.ndarray
    planes: np.ndarray      # (anchors, levels, planes, words)
    step: np.ndarray        # (anchors, levels): what a unit of the planes is worth
    base: np.ndarray        # (anchors, levels): the popcounts' sum of a code of -1 only
    low: np.ndarray         # (anchors, levels): the value of plane sums of nought
    error: np.ndarray       # (anchors, levels): how far a code's inner product may be off

    @staticmethod
    def of(ids: np.ndarray, labels: np.ndarray, x: np.ndarray, turns: np.ndarray, planes: int = PLANES) -> Queries:
        dim = x.shape[1]
        o = np.einsum("ad,lkd->alk", x.astype(float), turns)
        low, high = o.min(2), o.max(2)
        step = np.maximum(high - low, 1e-300) / ((1 << planes) - 1)
        units = np.clip(np.rint((o - low[..., None]) / step[..., None]), 0, (1 << planes) - 1).astype(np.uint32)
        error = np.abs(o - (low[..., None] + step[..., None] * units)).sum(2) / np.sqrt(dim)
        bits = np.stack([units >> p & 1 for p in range(planes)], 2).astype(np.uint8)
        return Queries(ids, labels, x, np.linalg.norm(x.astype(float), axis=1),
                       _words(np.packbits(bits, axis=3, bitorder="little")), step,
                       units.sum(2).astype(float), low, error)

    def bounds(self, codes: np.ndarray, align: np.ndarray, rest: np.ndarray, at) -> tuple[np.ndarray, np.ndarray]:
        """The score's estimate and how far off it may be, (rows, anchors ``at``)."""
        dim = self.x.shape[1]
        middle = np.zeros((len(rest), len(self.id[at])))
        off = rest[:, None] * self.length[at][None, :]
        for level in range(align.shape[1]):
            code = codes[:, level]                                           # (rows, words)
            ones = sum(np.bitwise_count(code[:, k]).astype(float) for k in range(code.shape[1]))
            total = np.zeros(middle.shape, np.uint32)
            for p in range(self.planes.shape[2]):
                plane = self.planes[at, level, p]
                for k in range(code.shape[1]):
                    total += np.bitwise_count(code[:, k, None] & plane[None, :, k]).astype(np.uint32) << np.uint32(p)
            # sum of +-q over the components is twice the sum over the code's ones less the sum over all
            t = (self.step[at, level] * (2.0 * total - self.base[at, level])
                 + self.low[at, level] * (2 * ones[:, None] - dim)) / np.sqrt(dim)
            middle += align[:, level, None] * t
            off += align[:, level, None] * self.error[at, level]
        return middle, off + SLACK * (align.sum(1) + rest)[:, None] * self.length[at][None, :] + SLACK


def exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of pairs of whole vectors."""
    return np.einsum("ij,ij->i", x, q)


class Best:
    """The first ``k`` (score, id) of each key: higher scores first, ties by smaller id, each id once."""

    def __init__(self, keys: int, k: int) -> None:
        self.k = k
        self.key, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))
        self.least = np.full(keys, np.iinfo(np.int64).min)          # a score that can still enter

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        key, score, ids = (np.concatenate(x) for x in ((self.key, key), (self.score, score), (self.id, ids)))
        order = np.lexsort((-score, ids, key))
        key, score, ids = key[order], score[order], ids[order]
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])
        key, score, ids = key[first], score[first], ids[first]
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        place = np.arange(len(key)) - np.searchsorted(key, key)
        held = place < self.k
        self.key, self.score, self.id = key[held], score[held], ids[held]
        full = place == self.k - 1
        self.least[key[full]] = score[full]


def _fixed(column: pa.Array, kind, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), dim)


def _coded(levels: int, seed: int):
    """Rows of whole vectors to rows with their codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = np.diff(batch.column("x").offsets.to_numpy())
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                x = part.column("x").flatten().to_numpy().reshape(-1, dim)
                if dim not in turns:
                    turns[dim] = rotations(int(dim), levels, seed)
                codes, align, rest = encode(x, turns[dim])
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), part.column("label"), pa.array(np.full(len(x), dim, np.int32)),
                    pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in codes], pa.binary()),
                    pa.array([r.tobytes() for r in align], pa.binary()), pa.array(rest)], CODED_NAMES)

    return run


CODED_NAMES = [c.split()[0] for c in CODED.split(", ")]


def coded(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label",
          vector_col: str = "embedding", scale: int = SCALE, levels: int = LEVELS, seed: int = SEED) -> DataFrame:
    """The rows that take part, with whole components and codes, written once."""
    whole = F.transform("v", lambda c: F.floor(F.lit(scale).cast("double") * c.cast("double")))
    # a component beyond this could make a score of more than 62 bits
    most = F.sqrt(F.lit(2.0 ** 62) / F.size("v")) / scale
    fine = F.forall("v", lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < most), F.lit(False)))
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                           F.col(vector_col).alias("v"))
            .where("id is not null and label is not null and v is not null and size(v) > 0").where(fine)
            .select("id", "label", whole.alias("x")))
    return materialise(spark, rows.mapInArrow(_coded(levels, seed), CODED), "negatives-codes")


def _parts(batch: pa.RecordBatch, dims: dict[int, Queries], levels: int):
    """The batch's rows by dimension, as many at a time as CELLS allows: (queries, id, label, x, codes, align, rest)."""
    sizes = batch.column("dim").to_numpy()
    for dim in np.unique(sizes):
        q = dims.get(int(dim))
        if q is None:
            continue
        part = batch.filter(pa.array(sizes == dim))
        x = _fixed(part.column("x"), np.int64, dim)
        codes = _words(_fixed(part.column("codes"), np.uint8, levels * -(-dim // 8)).reshape(len(x), levels, -1))
        align = _fixed(part.column("align"), float, levels)
        ids, label, rest = (part.column(c).to_numpy() for c in ("id", "label", "rest"))
        step = max(1, CELLS // len(q.id))
        for i in range(0, len(x), step):
            s = slice(i, i + step)
            yield int(dim), q, ids[s], label[s], x[s], codes[s], align[s], rest[s]


def _positives(block, k: int, levels: int):
    """Each anchor's first ``k`` rows of its label among a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims = block.value
        best = {d: Best(len(q.id), k) for d, q in dims.items()}
        for batch in batches:
            for dim, q, ids, label, x, codes, align, rest in _parts(batch, dims, levels):
                for value in np.unique(label):
                    at, of = np.flatnonzero(q.label == value), np.flatnonzero(label == value)
                    if not len(at):
                        continue
                    middle, off = q.bounds(codes[of], align[of], rest[of], at)
                    r, a = np.nonzero(middle + off >= best[dim].least[at][None, :])
                    r, a = of[r], at[a]
                    other = ids[r] != q.id[a]
                    r, a = r[other], a[other]
                    best[dim].add(a, exact(x[r], q.x[a]), ids[r])
        for dim, b in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(dims[dim].id[b.key]), pa.array(b.id), pa.array(b.score)],
                                             ["anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(block, k: int, low: int, high: int, levels: int):
    """For each anchor and positive the first ``k`` rows of other labels between the bounds, among a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims, positives = block.value
        best = {d: Best(s.size, k) for d, (_, s, _) in positives.items()}
        for batch in batches:
            for dim, q, ids, label, x, codes, align, rest in _parts(batch, dims, levels):
                (_, s, held), b = positives[dim], best[dim]
                spare = 1 + SLACK * np.abs(s)
                floor = np.where(held, np.maximum(b.least.reshape(s.shape), s * (low / 100)) - spare, np.inf).min(1)
                roof = np.where(held, s * (high / 100) + spare, -np.inf).max(1)
                middle, off = q.bounds(codes, align, rest, slice(None))
                r, a = np.nonzero((middle + off >= floor) & (middle - off <= roof) & (label[:, None] != q.label))
                other = ids[r] != q.id[a]
                r, a = r[other], a[other]
                got = exact(x[r], q.x[a])
                for place in range(s.shape[1]):
                    p = s[a, place]
                    fits = held[a, place] & _within(got, p, low, high) & (got >= b.least[a * s.shape[1] + place])
                    if fits.any():
                        b.add(a[fits] * s.shape[1] + place, got[fits], ids[r[fits]])
        for dim, b in best.items():
            pos, s, _ = positives[dim]
            a, place = np.divmod(b.key, s.shape[1])
            yield pa.RecordBatch.from_arrays([
                pa.array(dims[dim].id[a]), pa.array(pos[a, place]), pa.array(s[a, place]), pa.array(b.id), pa.array(b.score)],
                ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return run


def _within(score: np.ndarray, positive: np.ndarray, low: int, high: int) -> np.ndarray:
    """low * positive <= 100 * score <= high * positive, without leaving 64 bits."""
    def at_most(a, x, b, y):              # a * x <= b * y by whole parts of 100 and what is left
        left, right = a * (x // 100), b * (y // 100)
        spare = b * (y % 100) - a * (x % 100)
        return left - right <= np.floor_divide(spare, 100)

    return at_most(low, positive, 100, score) & at_most(100, score, high, positive)


def mine(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding", every: int = ANCHOR_EVERY, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
         levels: int = LEVELS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    rows = coded(spark, vectors, id_col, label_col, vector_col, scale, levels, seed)
    least = F.min(F.struct("label", "x", "dim")).alias("a")
    anchors = materialise(spark, rows.where(F.pmod("id", F.lit(every)) == 0).groupBy("id").agg(least)
                          .select("id", "a.label", "a.x", "a.dim"), "negatives-anchors")
    blocks = -(-anchors.count() // block)
    out = None
    for i in range(blocks):
        # a block's anchors, a block's worth of positives: what the driver holds doesn't grow with the table
        of = anchors.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).orderBy("id").collect()
        dims = {}
        for dim in sorted({r.dim for r in of}):
            own = [r for r in of if r.dim == dim]
            dims[dim] = Queries.of(np.array([r.id for r in own]), np.array([r.label for r in own]),
                                   np.frombuffer(b"".join(bytes(r.x) for r in own), np.int64).reshape(-1, dim),
                                   rotations(dim, levels, seed))
        shared = spark.sparkContext.broadcast(dims)
        by = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
        found = (rows.mapInArrow(_positives(shared, positives, levels), "anchor_id long, positive_id long, positive_score long")
                 .groupBy("anchor_id", "positive_id").agg(F.max("positive_score").alias("positive_score"))
                 .withColumn("place", F.row_number().over(by)).where(F.col("place") <= positives).collect())
        places = {d: tuple(np.zeros((len(q.id), positives), t) for t in (np.int64, np.int64, bool)) for d, q in dims.items()}
        where = {a: (d, j) for d, q in dims.items() for j, a in enumerate(q.id.tolist())}
        for r in found:
            d, j = where[r.anchor_id]
            for of, value in zip(places[d], (r.positive_id, r.positive_score, True)):
                of[j, r.place - 1] = value
        both = spark.sparkContext.broadcast((dims, places))
        by = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
        schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
        part = materialise(spark, rows.mapInArrow(_negatives(both, negatives, low, high, levels), schema)
                           .groupBy("anchor_id", "positive_id", "positive_score", "negative_id")
                           .agg(F.max("negative_score").alias("negative_score"))
                           .withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= negatives)
                           .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"),
                           f"negatives-{i}")
        shared.unpersist()
        both.unpersist()
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                        "positive_score long, negative_score long")
    return out
