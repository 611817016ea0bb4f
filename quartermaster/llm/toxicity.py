"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learned: words and their beginnings of ``STEM`` code points that
are much commoner in toxic texts than in others (smoothed log odds of texts). A
text's FEATURES are how many lexicon words it has and how strong they are, by
themselves and for each word; how near a second-person pronoun stands; capitals;
punctuation; and obfuscation: symbols inside words, letters drawn out or spaced,
and lexicon words found only after these are undone.

Labelled texts fall into ``PARTS`` by a hash of the text, so that equal texts
stay together. In training each text is seen through the lexicon of the other
parts, as an unseen text would be. Spark ML's boosted trees learn from all parts
but the last, and isotonic regression maps their margins to shares of toxic
texts on the last, weighted by how common each label is.

The fit takes ``SAMPLE_PER_CLASS`` labelled texts of the lowest id hashes in each
class at most; scoring covers every whole text.

Defined cases: a null text is an empty text and is scored as one; ids with
contradicting or null labels teach nothing; without texts of both classes every
score is the labels' own (0 or 1; 0 without labels); equal texts get equal
scores; repeated rows are scored row by row; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise

SAMPLE_PER_CLASS = 5000
PARTS = 4
STEM = (3, 4, 5, 6, 7)        # code points of a word's beginning that the lexicon may hold
LEAST_TEXTS = 3               # toxic texts that a unit of the lexicon is in
LEAST_ODDS = 1.5              # log odds from which a unit is in the lexicon
STRONG_ODDS = 3.0
LEXICON_SIZE = 20_000         # units of the highest odds
NEAR = 5                      # words between a lexicon word and a pronoun
TREES, DEPTH, STEP = 20, 3, 0.3
SEED = 42
FIT_TASKS = 8                 # partitions of the sample
REMEMBERED = 200_000          # words whose strength a task keeps at hand

# Second-person pronouns of English, German, French and Spanish.
SECOND_PERSON = frozenset("""
you your yours yourself yourselves u ur thou thee thy
du dich dir dein deine deinen deinem deiner ihr euch euer eure
tu te toi ton ta tes vous votre vos
tú ti contigo tuyo tuya usted ustedes vosotros vuestro vuestra
""".split())
# Letters that symbols and digits stand for.
STANDS_FOR = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i",
                            "*": None, "#": None, "_": None, "-": None, ".": None, "+": "t"})
WORD = re.compile(r"[^\W_]+")
BEFORE_LETTER = re.compile(r"[0-9@$!|*#_+]+(?=[^\W\d_])")
MIXED = re.compile(r"[^\W\d_]+(?:[0-9@$!|*#_+]+[^\W\d_]+)+")      # symbols or digits between letters
SPACED = re.compile(r"(?<!\w)[^\W\d_](?:[ .*_-][^\W\d_]){2,}(?!\w)")
DRAWN_OUT = re.compile(r"([^\W\d_])\1{2,}")
MARKS = re.compile(r"[!?]{2,}")
FEATURES = ("words", "hits", "strong_hits", "distinct_hits", "density", "strong_density", "most", "second", "hidden_hits",
            "near_share", "nearest", "second_person", "capitals", "shouted", "exclamations", "questions", "mark_runs",
            "mixed", "spaced", "drawn_out")


def units(word: str) -> list[str]:
    """What the lexicon may hold of a word: ``=`` and the word, and its beginnings."""
    return ["=" + word, *[word[:k] for k in STEM if len(word) > k]]


class Strengths(dict):
    """A word's log odds by the lexicon, 0 where it has none; kept for the words met most recently."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = found = max((self.lexicon.get(u, 0.0) for u in units(word)), default=0.0)
        return found


def obfuscated(text: str, words: list[str]) -> tuple[list[str], list[str], list[str]]:
    """What of a text in lower case mixes symbols into letters, spaces letters out, or repeats them."""
    mixed = [x for t in text.split() if BEFORE_LETTER.search(t, 1) for x in MIXED.findall(t)] \
        if BEFORE_LETTER.search(text) else []
    drawn = [w for w in words if DRAWN_OUT.search(w)] if DRAWN_OUT.search(text) else []
    return mixed, SPACED.findall(text), drawn


def undone(mixed: list[str], spaced: list[str], drawn: list[str]) -> list[str]:
    """The words that may be meant."""
    return [*[x.translate(STANDS_FOR) for x in mixed], *["".join(WORD.findall(x)) for x in spaced],
            *[DRAWN_OUT.sub(to, w) for w in drawn for to in (r"\1", r"\1\1")]]


def features(raw: str | None, strengths: Strengths) -> list[float]:
    """The FEATURES of a text, each bounded."""
    raw = raw or ""
    text = raw.lower()
    words = WORD.findall(text)
    n = max(len(words), 1)
    of = list(map(strengths.__getitem__, words))
    at = [i for i, x in enumerate(of) if x]
    odds = sorted((of[i] for i in at), reverse=True)
    strong = sum(x >= STRONG_ODDS for x in odds)
    mixed, spaced, drawn = obfuscated(text, words)
    found = sum(strengths[x] >= STRONG_ODDS for x in undone(mixed, spaced, drawn))
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    distances = []
    j = 0
    for i in at if you else ():
        while j + 1 < len(you) and abs(you[j + 1] - i) <= abs(you[j] - i):
            j += 1
        distances.append(abs(you[j] - i))
    letters, capitals = max(sum(map(str.isalpha, raw)), 1), sum(map(str.isupper, raw))
    tokens = raw.split()
    return [
        math.log1p(len(words)), math.log1p(len(at)), math.log1p(strong), math.log1p(len({words[i] for i in at})),
        100 * len(at) / n, 100 * strong / n, odds[0] if odds else 0.0, odds[1] if len(odds) > 1 else 0.0,
        math.log1p(found), sum(d <= NEAR for d in distances) / max(len(at), 1), 1 / (1 + min(distances, default=99)),
        100 * len(you) / n, capitals / letters,
        sum(map(str.isupper, tokens)) / max(len(tokens), 1),
        min(raw.count("!") / n, 3.0), min(raw.count("?") / n, 3.0), min(len(MARKS.findall(raw)) / n, 3.0),
        len(mixed) / n, len(spaced) / n, len(drawn) / n]


@dataclass(frozen=True)
class Model:
    """A lexicon, trees and the map from margins to shares; without trees, ``share`` for every text."""

    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    shares: IsotonicRegressionModel | None
    share: float = 0.0

    def applied(self, featured: DataFrame) -> DataFrame:
        """``score`` beside the array ``x`` of features."""
        if self.trees is None:
            return featured.withColumn("score", F.lit(float(self.share))).drop("x")
        out = self.shares.transform(_margins(featured, self.trees))
        return out.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "share"))).drop("share", "margin")


def _margins(featured: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    out = trees.transform(featured.withColumn("features", array_to_vector("x")))
    return out.withColumn("margin", vector_to_array("rawPrediction")[1]).drop(
        "features", "x", "rawPrediction", "probability", "prediction")


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each part and class a unit is; partial counts."""
    for batch in batches:
        held: dict[tuple[int, bool], Counter] = defaultdict(Counter)
        for part, toxic, text in zip(*(batch.column(c).to_pylist() for c in ("part", "toxic", "text"))):
            held[part, toxic].update({u for w in set(WORD.findall((text or "").lower())) for u in units(w)})
            if sum(map(len, held.values())) > REMEMBERED:
                yield _counted(held)
        yield _counted(held)


def _counted(held: dict[tuple[int, bool], Counter]) -> pa.RecordBatch:
    """(part, toxic, unit, n), and nothing is held any more."""
    rows = [(part, toxic, u, n) for (part, toxic), c in held.items() for u, n in c.items()]
    held.clear()
    part, toxic, unit, n = zip(*rows) if rows else ((),) * 4
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(toxic, pa.bool_()), pa.array(unit, pa.string()),
                                       pa.array(n, pa.int64())], ["part", "toxic", "unit", "n"])


def _odds(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))


def lexicons(sample: DataFrame, parts: int = PARTS, size: int = LEXICON_SIZE) -> list[dict[str, float]]:
    """The lexicon of all parts but one, for each part, and last that of all parts."""
    in_part = [F.coalesce(F.sum(F.when((F.col("part") == p) & (F.col("toxic") == t), F.col("n"))), F.lit(0)).alias(f"c{p}{int(t)}")
               for p in range(parts) for t in (False, True)]
    n = sample.withColumn("n", F.lit(1)).agg(*in_part).first()
    toxic, clean = (sum(F.col(f"c{p}{t}") for p in range(parts)) for t in (1, 0))
    n_toxic, n_clean = (sum(n[f"c{p}{t}"] for p in range(parts)) for t in (1, 0))
    odds = (F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n_clean + 1)))
    rows = (sample.select("part", "toxic", "text").mapInArrow(_units, "part int, toxic boolean, unit string, n long")
            .groupBy("unit").agg(*in_part).where(toxic >= LEAST_TEXTS).where(odds >= LEAST_ODDS)
            .orderBy(F.desc(odds), "unit").limit(size).collect())
    out = []
    for left_out in [*range(parts), None]:
        of = [p for p in range(parts) if p != left_out]
        sums = [sum(n[f"c{p}{t}"] for p in of) for t in (1, 0)]
        own = {}
        for r in rows:
            a, b = (sum(r[f"c{p}{t}"] for p in of) for t in (1, 0))
            if a >= LEAST_TEXTS and (w := _odds(a, b, *sums)) >= LEAST_ODDS:
                own[r.unit] = w
        out.append(own)
    return out


def _featured(lexicons_: list[dict[str, float]], keep: list[str]):
    """Rows with the features of their texts, by the lexicon of their part (the last one without parts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_part = [Strengths(x) for x in lexicons_]
        for batch in batches:
            texts = batch.column("text")
            parts = batch.column("part").to_pylist() if "part" in keep else [-1] * len(texts)
            x = pa.array([features(t.as_py(), by_part[p]) for t, p in zip(texts, parts)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], x], [*keep, "x"])

    return run


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", per_class: int = SAMPLE_PER_CLASS, trees: int = TREES, depth: int = DEPTH,
          seed: int = SEED) -> Model:
    """A model from the labels given (1 toxic, 0 not); the caller keeps held-out rows out of them."""
    known = (labels.select(F.col(id_col).alias("id"), (F.col(label_col) == 1).alias("toxic"))
             .where("id is not null and toxic is not null").groupBy("id")
             .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").select("id", "toxic"))
    by_hash = [F.xxhash64("id"), F.col("id")]
    ids = (known.where("toxic").orderBy(*by_hash).limit(per_class)
           .unionByName(known.where("not toxic").orderBy(*by_hash).limit(per_class)))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the ids are 2 * per_class rows at most; an id's least text counts where rows share an id
    sample = (texts.join(F.broadcast(ids), "id").groupBy("id", "toxic").agg(F.min("text").alias("text"))
              .repartition(FIT_TASKS, "id").withColumn("part", F.pmod(F.xxhash64("text"), F.lit(PARTS)).cast("int")))
    sample = materialise(spark, sample, "toxicity-sample")
    total = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    found = {r.toxic: r for r in sample.groupBy("toxic").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("part") == PARTS - 1, 1)).alias("last")).collect()}
    if len(found) < 2:
        return Model({}, None, None, float(next(iter(found), False)))
    own = lexicons(sample)
    x = materialise(spark, sample.mapInArrow(_featured(own, ["id", "toxic", "part"]), "id {}, toxic boolean, part int, x array<double>"
                    .format(sample.schema["id"].dataType.simpleString())), "toxicity-features")
    # the last part is for calibration, if it and the rest have texts of both classes
    split = all(0 < r["last"] < r["n"] for r in found.values())
    weight = F.lit(1.0)
    for toxic, r in found.items():
        weight = F.when(F.col("toxic") == toxic, F.lit(total[toxic] / r["n"])).otherwise(weight)
    x = x.withColumn("label", F.col("toxic").cast("double")).withColumn("weight", weight)
    # every level of every tree is a job, so the few rows lie in few partitions
    learned = (x.where(F.col("part") < PARTS - 1) if split else x).orderBy("id").coalesce(FIT_TASKS // 2).select(
        "label", array_to_vector("x").alias("features"))
    boosted = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=STEP, seed=seed, minInstancesPerNode=2).fit(learned)
    held = x.where(F.col("part") == PARTS - 1) if split else x
    isotonic = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="share", weightCol="weight")
    return Model(own[-1], boosted, isotonic.fit(_margins(held, boosted)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row: the share of toxic texts among those like it."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    featured = base.mapInArrow(_featured([model.lexicon], ["id"]), f"id {kind}, x array<double>")
    return model.applied(featured).select(F.col("id").alias(id_col), "score")
