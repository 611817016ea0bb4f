"""Language identification with interpolated Kneser-Ney character models.

One model per language over 4-character grams of the lower-cased letters (all
else is one space). The grams of every training text are counted, whole. The
highest order has raw counts, the lower orders continuation counts (how many
different characters precede), and each order is discounted by n1/(n1 + 2 n2)
and interpolated with the next lower one. Grams are 64-bit keys, four 16-bit
characters, kept in sorted arrays that a binary search looks up; the probability
of every gram that any language has is precomputed for all languages. A text gets
the language of the lowest cross-entropy per character. It is rejected where that
exceeds what the language's own training texts show (calibrated on all of
them).

The counts grow with the corpus, and no gram is left out. Up to ``MAX_GRAMS`` grams
over all languages and ``MAX_CELLS`` probabilities the tasks receive the model; a
larger one stays in Parquet (``Tables``): discounts, continuation counts and
probabilities are grouped aggregates and joins, and the grams of the texts are
joined to them. Both give the same cross-entropies, but for rounding.

Defined cases: a null text or one without letters is "und" with score 0; texts
without a language teach nothing; with no training text at all every text is
"und"; equal cross-entropies give the language that sorts first; repeated rows
are judged row by row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise

ORDER = 4
MAX_GRAMS, MAX_CELLS = 2_000_000, 16_000_000
CHUNK_CHARS = 1_000_000       # text that is handled at once; a longer one in pieces of this size
CHUNK_CELLS = 4_000_000       # log-probabilities (grams times languages) that are gathered at once
HOT_ROWS = 20_000             # probes of one key that a task of the join takes
FLUSH_GRAMS = 2_000_000       # grams that a counting task holds before it passes them on
REJECT_QUANTILE, REJECT_MARGIN = 0.995, 0.5
CONFIDENT_CHARS = 20          # characters after which more text no longer sharpens the score

_LIMIT = 0x20000              # code points from here on count as letters


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(_LIMIT)] + [True])


def _mask(order: int) -> np.uint64:
    return np.uint64((1 << 16 * order) - 1)


def gram_keys(texts: list[str], letters: np.ndarray, edges: list[tuple[int, int]] | None = None
              ) -> tuple[np.ndarray, np.ndarray]:
    """(the key of the gram that ends at each kept character, bounds of the texts in it).

    ``edges``: by text, how many of its first and last kept characters count as context only.
    """
    low = [t.lower() for t in texts]
    chars = np.frombuffer(("\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = letters[np.minimum(chars, _LIMIT)]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]                         # a letter, or the first of what follows one
    ends = np.cumsum(keep)[np.cumsum([len(t) + 1 for t in low]) - 1]
    bounds = np.concatenate([[0], ends])
    c = np.where(is_letter, chars & 0xFFFF, 0)[keep].astype(np.uint64)
    at = np.arange(len(c)) - np.repeat(bounds[:-1], np.diff(bounds))
    keys = c.copy()
    for k in range(1, ORDER):
        before = np.concatenate([np.zeros(min(k, len(c)), np.uint64), c[:-k]])
        before[at < k] = 0
        keys |= before << np.uint64(16 * k)
    if edges and any(map(any, edges)):
        n, (first, last) = np.diff(bounds), np.array(edges).T
        keys = keys[(at >= np.repeat(first, n)) & (at < np.repeat(n - last, n))]
        bounds = np.concatenate([[0], np.cumsum(n - first - last)])
    return keys, bounds


def _is_letter(c: str) -> bool:
    return c.isalpha() or ord(c) >= _LIMIT


def _context(text: str) -> str:
    """The last kept characters of a lower-case text, from a letter on, that the grams after it need."""
    kept = []
    for i in range(len(text) - 1, -1, -1):
        letter = _is_letter(text[i])
        if letter or i and _is_letter(text[i - 1]):
            kept.append(text[i] if letter else " ")
            if letter and len(kept) >= ORDER - 1:
                break
    return "".join(reversed(kept))


def pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[str], list[tuple[int, int]]]]:
    """The texts in groups of about CHUNK_CHARS, each with its number; a longer text in pieces.

    A later piece begins with the kept characters before it, and a piece that another follows
    has no end of its own: the third list is ``gram_keys``' edges.
    """
    who, group, edges, size = [], [], [], 0
    for i, t in enumerate(texts):
        if not t:
            continue
        low, context = t if len(t) <= CHUNK_CHARS else t.lower(), ""
        for at in range(0, len(low), CHUNK_CHARS):
            piece = context + low[at:at + CHUNK_CHARS]
            if size and size + len(piece) > CHUNK_CHARS:
                yield who, group, edges
                who, group, edges, size = [], [], [], 0
            goes_on = at + CHUNK_CHARS < len(low)
            who.append(i)
            group.append(piece)
            edges.append((len(context), int(goes_on and _is_letter(piece[-1]))))
            size += len(piece)
            context = _context(piece) if goes_on else ""
    if group:
        yield who, group, edges


# --- counting ---------------------------------------------------------------------------------

def count_grams(train: DataFrame) -> DataFrame:
    """(lang, key, n) of all grams of the training frame (lang, text), whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, held = _letters(), {}

        def flush():
            for lang, (keys, n) in held.items():
                for a in range(0, len(keys), 100_000):
                    k = pa.array(keys[a:a + 100_000].view(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k)), k, pa.array(n[a:a + 100_000])],
                                                     ["lang", "key", "n"])
            held.clear()

        for batch in batches:
            by_lang = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for _, group, edges in pieces(texts):
                    keys, n = np.unique(gram_keys(group, letters, edges)[0], return_counts=True)
                    if lang in held:
                        keys = np.concatenate([held[lang][0], keys])
                        n = np.concatenate([held[lang][1], n])
                        keys, where = np.unique(keys, return_inverse=True)
                        n = np.bincount(where, weights=n).astype(np.int64)
                    held[lang] = keys, n
            if sum(len(k) for k, _ in held.values()) > FLUSH_GRAMS:
                yield from flush()
        yield from flush()

    parts = train.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(
        run, "lang string, key bigint, n bigint")
    return parts.groupBy("lang", "key").agg(F.sum("n").alias("n"))


# --- the model --------------------------------------------------------------------------------

class Model:
    """Kneser-Ney tables of every language, and the probabilities of all known grams."""

    def __init__(self, langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        self.langs = langs
        self.limits = np.full(len(langs), np.inf)       # cross-entropies above are rejected
        self.tables = [self._tables(keys, n) for keys, n in counts]
        known = [keys & _mask(1) for keys, _ in counts]
        self.floor = 1.0 / (len(np.unique(np.concatenate(known))) + 1 if known else 1)
        self.keys = np.unique(np.concatenate([keys for keys, _ in counts])) if counts else np.zeros(0, np.uint64)
        self.logs = self._logs(self.keys)

    @staticmethod
    def _tables(keys: np.ndarray, n: np.ndarray) -> list[tuple]:
        """By order from the highest: (keys, counts, contexts, their totals and types, discount)."""
        out = []
        for order in range(ORDER, 0, -1):
            sort = np.argsort(keys)
            keys, n = keys[sort], n[sort].astype(float)
            contexts, first, types = np.unique(keys >> np.uint64(16), return_index=True, return_counts=True)
            totals = np.add.reduceat(n, first) if len(n) else n
            once, twice = (n == 1).sum(), (n == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.75
            out.append((keys, n, contexts, totals, types.astype(float), float(discount)))
            keys, n = np.unique(keys & _mask(order - 1), return_counts=True)   # who follows how many
        return out

    def _probability(self, lang: int, level: int, keys: np.ndarray) -> np.ndarray:
        if level == ORDER:
            return np.full(len(keys), self.floor)
        known, n, contexts, totals, types, discount = self.tables[lang][level]
        lower = self._probability(lang, level + 1, keys & _mask(ORDER - level - 1))
        if not len(known):
            return lower
        i = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        count = np.where(known[i] == keys, n[i], 0.0)
        j = np.minimum(np.searchsorted(contexts, keys >> np.uint64(16)), len(contexts) - 1)
        seen = contexts[j] == keys >> np.uint64(16)
        return np.where(seen, (np.maximum(count - discount, 0) + discount * types[j] * lower) / totals[j], lower)

    def _logs(self, keys: np.ndarray) -> np.ndarray:
        """Natural log-probabilities, a row per gram and a column per language."""
        return np.stack([np.log(self._probability(i, 0, keys)) for i in range(len(self.langs))], 1).astype(
            np.float32) if self.langs else np.zeros((len(keys), 0), np.float32)

    @classmethod
    def of(cls, arrays: dict) -> Model:
        """The model whose ``vars`` were broadcast (plain arrays, so that any worker can read them)."""
        model = cls.__new__(cls)
        model.__dict__.update(arrays)
        return model

    def entropies(self, texts: list[str | None], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy per character by text and language, number of scored characters)."""
        total, size = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        for who, group, edges in pieces(texts):
            keys, bounds = gram_keys(group, letters, edges)
            if not len(keys) or not self.langs:
                continue
            who = np.array(who)
            step = max(1, CHUNK_CELLS // len(self.langs))
            for a in range(0, len(keys), step):
                part, cut = keys[a:a + step], np.clip(bounds - a, 0, min(step, len(keys) - a))
                i = np.minimum(np.searchsorted(self.keys, part), len(self.keys) - 1)
                logs = self.logs[i]
                missed = np.flatnonzero(self.keys[i] != part)
                if len(missed):
                    new, where = np.unique(part[missed], return_inverse=True)
                    logs[missed] = self._logs(new)[where]
                full = np.flatnonzero(np.diff(cut))
                np.add.at(total, who[full], np.add.reduceat(logs, cut[full], axis=0, dtype=np.float64))
            np.add.at(size, who, np.diff(bounds))
        return -total / np.maximum(size, 1)[:, None], size

    def judge(self, texts: list[str | None], letters: np.ndarray) -> tuple[list, list, list, list]:
        """(language, score, cross-entropy, accepted) of each text; language None without letters."""
        entropy, size = self.entropies(texts, letters)
        if not self.langs:
            n = len(texts)
            return [None] * n, [0.0] * n, [None] * n, [False] * n
        best = entropy.argmin(1)
        lowest = entropy[np.arange(len(texts)), best]
        sharp = np.minimum(size, CONFIDENT_CHARS)[:, None]
        score = 1.0 / np.exp((lowest[:, None] - entropy) * sharp).sum(1)
        found = size > 0
        return ([self.langs[b] if f else None for b, f in zip(best, found)], np.where(found, score, 0.0).tolist(),
                [float(e) if f else None for e, f in zip(lowest, found)],
                (found & (lowest <= self.limits[best])).tolist())


class Tables:
    """The same model in Parquet, of any size: what each gram and context adds to a log-probability.

    The probability of a gram is that of the next lower order, times the context's weight
    where the language has the context, times a rest where it has the gram. So its logarithm
    is a sum over (order, kind, key, lang, value) rows that are looked up one by one.
    """

    def __init__(self, spark: SparkSession, counts: DataFrame, langs: list[str]):
        self.spark, self.langs, self.limits = spark, langs, {}
        chars = counts.select(F.col("key").bitwiseAND(F.lit(int(_mask(1))))).distinct().count()
        self.log_floor = float(np.log(1.0 / (chars + 1)))
        levels, grams = [], counts.select("lang", "key", F.col("n").cast("double").alias("n"))
        for order in range(ORDER, 0, -1):
            levels.append((order, grams))
            if order > 1:
                lower = F.col("key").bitwiseAND(F.lit(int(_mask(order - 1))))
                grams = materialise(spark, grams.groupBy("lang", lower.alias("key")).agg(
                    F.count(F.lit(1)).cast("double").alias("n")), "langid-lower")      # who follows how many
        below, entries = None, None
        for order, grams in reversed(levels):
            once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
            discount = grams.groupBy("lang").agg(
                F.when((once > 0) & (twice > 0), once / (once + 2 * twice)).otherwise(0.75).alias("discount"))
            grams = grams.withColumn("context", F.shiftrightunsigned("key", 16))
            contexts = (grams.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"))
                        .join(F.broadcast(discount), "lang")
                        .withColumn("weight", F.col("discount") * F.col("types") / F.col("total")))
            found = grams.join(contexts, ["lang", "context"])
            if below is None:
                found = found.withColumn("lower", F.lit(self.log_floor))
            else:
                found = (found.withColumn("suffix", F.col("key").bitwiseAND(F.lit(int(_mask(order - 1)))))
                         .join(below, ["lang", "suffix"]))
            p = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total") + F.col("weight") * F.exp("lower")
            found = materialise(spark, found.select("lang", "key", F.log(p).alias("log"), (
                F.log(p) - F.log("weight") - F.col("lower")).alias("value")), "langid-log")
            below = found.select("lang", F.col("key").alias("suffix"), F.col("log").alias("lower"))
            each = found.select(F.lit(2 * order).alias("kind"), "key", "lang", "value").unionByName(
                contexts.select(F.lit(2 * order + 1).alias("kind"), F.col("context").alias("key"), "lang",
                                F.log("weight").alias("value")))
            entries = each if entries is None else entries.unionByName(each)
        self.entries = materialise(spark, entries, "langid-entries")

    def entropies(self, docs: DataFrame, own: bool = False) -> tuple[DataFrame, DataFrame]:
        """((row, id, size) of every row of (id, text), (row, size, lang, entropy) of those with letters).

        ``own``: the id is a language, and only the entropy under that one is computed.
        """

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            letters, row = _letters(), TaskContext.get().partitionId() << 40
            probe = pa.list_(pa.struct([("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64())]))
            for batch in batches:
                for i, text in enumerate(batch.column("text").to_pylist()):
                    parts = [np.unique(gram_keys(group, letters, edges)[0], return_counts=True)
                             for _, group, edges in pieces([text])]
                    key = np.concatenate([np.zeros(0, np.uint64), *[k for k, _ in parts]])
                    n = np.concatenate([np.zeros(0, np.int64), *[m for _, m in parts]])
                    out = [], [], []
                    for order in range(1, ORDER + 1):
                        gram = key & _mask(order)
                        for kind, keys in ((2 * order, gram), (2 * order + 1, gram >> np.uint64(16))):
                            keys, where = np.unique(keys, return_inverse=True)
                            out[0].append(np.full(len(keys), kind, np.int32))
                            out[1].append(keys.view(np.int64))
                            out[2].append(np.bincount(where, weights=n, minlength=len(keys)).astype(np.int64))
                    flat = pa.StructArray.from_arrays([pa.array(np.concatenate(x)) for x in out], ["kind", "key", "n"])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row], pa.int64()), batch.column("id").slice(i, 1), pa.array([int(n.sum())], pa.int64()),
                         pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat).cast(probe)],
                        ["row", "id", "size", "probes"])
                    row += 1

        kind = docs.schema["id"].dataType.simpleString()
        rows = materialise(self.spark, docs.mapInArrow(
            run, f"row bigint, id {kind}, size bigint, probes array<struct<kind:int,key:bigint,n:bigint>>"), "langid-rows")
        lang = [F.col("id").alias("lang")] if own else []
        probes = rows.select("row", "size", *lang, F.explode("probes").alias("p")).select(
            "row", "size", *["lang"] * own, "p.*")
        # a key of many rows is spread over several tasks, its entries go to each of them
        hot = materialise(self.spark, probes.groupBy("kind", "key").count().where(F.col("count") > HOT_ROWS).select(
            "kind", "key", F.ceil(F.col("count") / HOT_ROWS).cast("int").alias("spread")), "langid-hot")
        spread = F.coalesce("spread", F.lit(1))
        on = ["kind", "key"]
        left = (probes.join(F.broadcast(hot), on, "left")
                .withColumn("part", F.pmod(F.xxhash64("row"), spread).cast("int")).drop("spread"))
        right = (self.entries.join(F.broadcast(hot), on, "left")
                 .withColumn("part", F.explode(F.sequence(F.lit(0), spread - 1))).drop("spread"))
        sums = (left.join(right, [*on, "part", *["lang"] * own]).groupBy("row", "lang")
                .agg(F.first("size").alias("size"), F.sum(F.col("n") * F.col("value")).alias("sum")))
        return rows.select("row", "id", "size"), sums.select(
            "row", "size", "lang", (-self.log_floor - F.col("sum") / F.col("size")).alias("entropy"))

    def calibrate(self, rows: DataFrame) -> None:
        _, own = self.entropies(rows.select(F.col("lang").alias("id"), "text"), own=True)
        self.limits = {r.lang: r.q + REJECT_MARGIN for r in own.where(F.col("size") >= CONFIDENT_CHARS).groupBy("lang")
                       .agg(F.percentile_approx("entropy", REJECT_QUANTILE, 10000).alias("q")).collect()}

    def judge(self, docs: DataFrame) -> DataFrame:
        """(id, lang, score, cross_entropy, accepted) of every row of (id, text)."""
        rows, each = self.entropies(docs)
        best = (each.groupBy("row").agg(F.min(F.struct("entropy", "lang")).alias("best"), F.first("size").alias("n"),
                                        F.collect_list("entropy").alias("all")))
        sharp = F.least("n", F.lit(CONFIDENT_CHARS))
        shares = F.aggregate("all", F.lit(0.0), lambda acc, e: acc + F.exp((F.col("best.entropy") - e) * sharp))
        best = best.select("row", F.col("best.lang").alias("lang"), (1.0 / shares).alias("score"),
                           F.col("best.entropy").alias("cross_entropy"))
        limits = self.spark.createDataFrame([(x, self.limits.get(x)) for x in self.langs], "lang string, most double")
        accepted = F.col("lang").isNotNull() & (F.col("most").isNull() | (F.col("cross_entropy") <= F.col("most")))
        return (rows.join(best, "row", "left").join(F.broadcast(limits), "lang", "left")
                .select("id", "lang", F.coalesce("score", F.lit(0.0)).alias("score"), "cross_entropy",
                        accepted.alias("accepted")))


def train(spark: SparkSession, docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
          id_col: str = "doc_id") -> Model | Tables:
    """A model of every language in the frame, from all its texts that have one."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).alias("text")).where("lang is not null and text is not null")
    counts = materialise(spark, count_grams(rows), "langid-grams")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    size = counts.agg(F.count(F.lit(1)).alias("grams"), F.count_distinct("key").alias("keys")).first()
    if size.grams > MAX_GRAMS or size["keys"] * len(langs) > MAX_CELLS:
        model = Tables(spark, counts, langs)
        model.calibrate(rows)
        return model
    top = counts.toPandas()                             # MAX_GRAMS at most
    top = top.sort_values(["lang", "key"])
    each = [top[top.lang == x] for x in langs]
    model = Model(langs, [(x.key.to_numpy(np.int64).view(np.uint64), x.n.to_numpy(np.int64)) for x in each])
    _calibrate(rows, model)
    return model


def _calibrate(rows: DataFrame, model: Model) -> None:
    """Sets each language's rejection limit from all of its own training texts."""
    arrays = rows.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, letters = Model.of(arrays.value), _letters()
        for batch in batches:
            entropy, size = m.entropies(batch.column("text").to_pylist(), letters)
            own = [m.langs.index(x) for x in batch.column("lang").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(size),
                                              pa.array(entropy[np.arange(len(own)), own])], ["lang", "size", "entropy"])

    found = (rows.mapInArrow(run, "lang string, size bigint, entropy double").where(F.col("size") >= CONFIDENT_CHARS)
             .groupBy("lang").agg(F.percentile_approx("entropy", REJECT_QUANTILE, 10000).alias("q")).collect())
    for r in found:
        model.limits[model.langs.index(r.lang)] = r.q + REJECT_MARGIN


def identify(docs: DataFrame, model: Model | Tables, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang, score, cross_entropy, accepted): lang null without a letter; score in 0 to 1."""
    if isinstance(model, Tables):
        return model.judge(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                           ).withColumnRenamed("id", id_col)
    arrays = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, letters = Model.of(arrays.value), _letters()
        for batch in batches:
            lang, score, entropy, accepted = m.judge(batch.column("text").to_pylist(), letters)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(entropy, pa.float64()), pa.array(accepted, pa.bool_())],
                ["id", "lang", "score", "cross_entropy", "accepted"])

    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(run, f"id {kind}, lang string, score double, cross_entropy double, accepted boolean"
                           ).withColumnRenamed("id", id_col)


def predicted(lang: Column, accepted: Column | None = None) -> Column:
    """"und" for no language, and, where ``accepted`` is given, for a rejected one."""
    known = lang if accepted is None else F.when(accepted, lang)
    return F.coalesce(known, F.lit("und"))
