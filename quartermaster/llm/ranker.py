"""Quality classifier by Bradley-Terry pairwise ranking.

Each text has a vector of surface features. From labelled texts, pairs of a good
and a bad one are preferences; the logistic loss on their feature difference
gives the weights, so that a text's score is a Bradley-Terry strength. The
threshold is the score quantile at the share of bad texts among all labelled
ones, and the returned score is the logistic of the distance to it.

The fit takes a bounded sample, ``SAMPLE_PER_CLASS`` labelled texts of the lowest
id hashes in each class, and ``PAIRS_PER_TEXT`` partners for each; the threshold is
taken over all labelled texts, and scoring covers every whole text.

Defined cases: a null text is an empty text and is scored as one; ids with
contradicting or null labels teach nothing; without texts of both classes every
score is 0.5; equal scores get equal results; repeated rows are scored row by
row; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import is_bounded
from .common import materialise
from .quality_rules import Text

SAMPLE_PER_CLASS = 5000
PAIRS_PER_TEXT = 8
QUANTILE_ACCURACY = 1_000_000     # the threshold's rank is off by one in so many at most
RIDGE = 1e-3
STEPS = 30
SEED = 42
DIGITS = b"0123456789"
FEATURES = ("log_words", "word_chars", "symbols", "upper", "repeated", "duplicate_lines", "distinct_words",
            "commonest_word", "digits", "exclamations", "pipes", "stops", "words_per_line")


def features(raw: str | None) -> list[float]:
    """The FEATURES of a text, each bounded."""
    t = Text(raw)
    n, chars, lines = max(t.n_words, 1), max(len(t.data), 1), max(len(t.lines), 1)
    counts = Counter(t.words)
    return [
        float(np.log1p(t.n_words)), min(t.word_chars / n, 40.0), min(t.n_symbols / n, 3.0),
        t.n_upper / max(t.n_letters, 1), t.n_repeat_words / n, t.n_dup_lines / lines,
        len(counts) / n, max(counts.values(), default=0) / n,
        (len(t.data) - len(t.data.translate(None, DIGITS))) / chars,
        min(t.raw.count("!") / n, 3.0), min(t.raw.count("|") / n, 3.0), min(t.raw.count(".") / n, 3.0),
        float(np.log1p(n / lines)),
    ]


@dataclass(frozen=True)
class Ranker:
    """score(x) = logistic((weights . (x - mean) / spread - threshold) / scale)."""

    mean: list[float]
    spread: list[float]
    weights: list[float]
    threshold: float
    scale: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.mean)) / np.array(self.spread) @ np.array(self.weights)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip((self.strength(x) - self.threshold) / self.scale, -50, 50)))


def fit(x: np.ndarray, good: np.ndarray, bad_share: float, pairs: int = PAIRS_PER_TEXT, seed: int = SEED) -> Ranker:
    """Newton's method for the logistic loss on the differences of good and bad texts."""
    d = x.shape[1]
    if not good.any() or good.all():
        return Ranker([0.0] * d, [1.0] * d, [0.0] * d, 0.0, 1.0)
    mean, spread = x.mean(0), x.std(0) + 1e-6
    z = (x - mean) / spread
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    rng = np.random.default_rng(seed)
    many = max(len(up), len(down)) * pairs
    diff = z[rng.permutation(np.resize(up, many))] - z[rng.permutation(np.resize(down, many))]
    w = np.zeros(d)
    for _ in range(STEPS):
        p = 1.0 / (1.0 + np.exp(-np.clip(diff @ w, -30, 30)))
        gradient = diff.T @ (p - 1.0) / many + RIDGE * w
        curve = (diff * (p * (1 - p))[:, None]).T @ diff / many + RIDGE * np.eye(d)
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    strength = z @ w
    # the sample is even between the classes; weighed back, its quantile is that of all labelled texts
    weight = np.where(good, (1 - bad_share) / good.sum(), bad_share / (~good).sum())
    order = np.argsort(strength, kind="stable")
    at = int(np.searchsorted(np.cumsum(weight[order]), bad_share * (1 + 1e-9)))
    low, high = strength[order[max(at - 1, 0)]], strength[order[min(at, len(order) - 1)]]
    return Ranker(mean.tolist(), spread.tolist(), w.tolist(), float((low + high) / 2), float(strength.std() / 4 + 1e-6))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = pa.array([features(t.as_py()) for t in batch.column("text")], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("good"), x], ["id", "good", "x"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> Ranker:
    """A ranker from the labels given (1 good, 0 bad); the caller keeps held-out rows out of them."""
    known = (labels.select(F.col(id_col).alias("id"), (F.col(label_col) == 1).alias("good"))
             .where("id is not null and good is not null").groupBy("id")
             .agg(F.min("good").alias("good"), F.max("good").alias("most")).where("good = most").select("id", "good"))
    counts = {r.good: r["count"] for r in known.groupBy("good").count().collect()}
    by_hash = [F.xxhash64("id"), F.col("id")]
    ids = (known.where("good").orderBy(*by_hash).limit(per_class)
           .unionByName(known.where("not good").orderBy(*by_hash).limit(per_class)))
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")
    kind = sample.schema["id"].dataType.simpleString()
    rows = (sample.select("id", "good", "text").mapInArrow(_featured, f"id {kind}, good boolean, x array<double>")
            .groupBy("id").agg(F.min("good").alias("good"), F.min("x").alias("x"))       # of several texts, the least
            .orderBy("id").select("good", "x").collect())                                # 2 * per_class rows at most
    x = np.array([r.x for r in rows], float).reshape(len(rows), len(FEATURES))
    share = counts.get(False, 0) / max(sum(counts.values()), 1)
    model = fit(x, np.array([r.good for r in rows], bool), share)
    if not any(model.weights):
        return model
    return replace(model, threshold=_threshold(docs, known, model, share, id_col, text_col))


def _threshold(docs: DataFrame, known: DataFrame, model: Ranker, share: float, id_col: str, text_col: str) -> float:
    """The middle of the gap at the quantile ``share`` of the strengths of all labelled texts, one for each id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column("text")], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.strength(x))], ["id", "strength"])

    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    ids = materialise(docs.sparkSession, known.select("id"), "ranker-labelled")
    if is_bounded(ids):                                # only labelled texts get features
        all_ = base.join(F.broadcast(ids), "id", "left_semi").mapInArrow(run, f"id {kind}, strength double")
    else:                                              # strengths first: the join moves a number for each text
        all_ = base.mapInArrow(run, f"id {kind}, strength double").join(ids, "id")
    all_ = materialise(docs.sparkSession, all_.groupBy("id").agg(F.min("strength").alias("strength")), "ranker-strengths")
    low = all_.agg(F.percentile_approx("strength", share, QUANTILE_ACCURACY)).first()[0]
    high = all_.where(F.col("strength") > low).agg(F.min("strength")).first()[0]
    return float(low if high is None else (low + high) / 2)


def score(docs: DataFrame, ranker: Ranker, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row; a score of 0.5 or more is on the good side of the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column("text")], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ranker.score(x))], ["id", "score"])

    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
