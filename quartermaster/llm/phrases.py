"""Phrase collocation mining by prefix-free parsing.

Texts are split into pieces and words. A phrase can reach the least count only if
its words and pairs do, so words, then pairs of frequent words, are counted by a
64-bit hash, which can only count too many. The runs of frequent pairs in a piece are cut
into chunks at trigger windows, runs of ``max_words - 1`` words whose checksums add
up to a multiple of ``TRIGGER`` (a run of ``WHOLE`` words or fewer is one chunk); a
chunk ends with the window that the next one begins with. Equal content is cut
alike wherever it stands, so copies and shared passages become one row of the
dictionary with a count. Phrases are counted inside the distinct chunks, weighted
by those counts. A phrase belongs to the chunk in which it begins before the
closing window, so that one inside an overlap counts once.

Longer phrases are first counted by hash, level by level: a phrase of n words can
reach the least count only if both of its parts of n - 1 words do. What passed a level
is a Bloom filter (of 32 bits a phrase, 2**29 at most) that goes to the tasks: it lets
through every frequent phrase and a few others. What it lets through is counted as
text, so that the others fail; words are so counted where the dictionary is made.

Defined cases: a null text is empty and a null language is ``und``; repeated rows
and ids count each time; texts without a word and empty tables give no rows;
equal scores go by count, then by phrase; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property, reduce
from itertools import accumulate
from operator import sub

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from .common import materialise

ENDS, UPPER = b".,;:!?\x0b\x0c\r", bytes(range(65, 91))
PLAIN = bytes.maketrans(ENDS + UPPER + b"\t", b"\n" * len(ENDS) + UPPER.lower() + b" ")      # a piece is a line of the plain text
TRIGGER = 8                   # one window in so many ends a chunk
WHOLE = 16                    # a run of so many words is a chunk
SLICE = 1 << 21               # bytes of text that a task looks at together
MIN_COUNT, MAX_WORDS, PER_LANG = 100, 5, 2000
COVERED = 100                 # percent of its occurrences that a longer phrase must hold to replace a phrase
HELD = 200_000                # distinct keys that a task gathers before it hands them on
FILTER_BITS, MOST_BITS = 32, 1 << 29
CODES_HELD = 2_000_000        # codes that a task gathers before it sums and hands them on
PART_BITS = 10                # counts are summed a part at a time: of a hash, the first bits
LONG = 64                     # bytes of a word hashed along with the others
PROBES = 20, 0                # a code's bits in a filter are chosen by so many ..
CHOOSE = 44                   # .. bits of the code from these on
BUCKET = 32_768               # bits of one bitmap of Spark's bitmap_construct_agg


def chunks(words: list[bytes], w: int, trigger: int = TRIGGER, whole: int = WHOLE) -> list[tuple[bytes, int]]:
    """The chunks of one run, and of how many words the phrases that begin there are the chunk's own."""
    n, start, found = len(words), 0, []
    if n > whole:
        upto = [0, *accumulate(map(zlib.crc32, words))]
        for i in [i for i, x in enumerate(map(sub, upto[w + 1:], upto[1:]), 1) if not x % trigger]:
            found.append((b" ".join(words[start:i + w]), i - start))
            start = i
    if n:
        found.append((b" ".join(words[start:]), n - start))
    return found


class Gathered:
    """Counts of one task by (lang, phrase, number), handed on whenever there are HELD of them."""

    def __init__(self) -> None:
        self.counts: dict[tuple[str, int], Counter] = defaultdict(Counter)

    def full(self) -> bool:
        return sum(map(len, self.counts.values())) > HELD

    def taken(self) -> pa.RecordBatch:
        """(lang, phrase, number, n), and nothing is held any more."""
        rows = [(lang, number, c) for (lang, number), c in self.counts.items()]
        sizes = [len(c) for *_, c in rows]
        out = pa.RecordBatch.from_arrays([
            pa.array([x[0] for x in rows], pa.string()).take(pa.array(np.repeat(np.arange(len(rows)), sizes))),
            pa.array([p for *_, c in rows for p in c], pa.binary()).cast(pa.string()),
            pa.array(np.repeat(np.array([x[1] for x in rows], np.int32), sizes), pa.int32()),
            pa.array([n for *_, c in rows for n in c.values()], pa.int64())], ["lang", "phrase", "number", "n"])
        self.counts.clear()
        return out


GATHERED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("number", pa.int32()), ("n", pa.int64())])
CODES = pa.schema([("code", pa.int64()), ("n", pa.int64())])


def _gathering(each: Callable[[pa.RecordBatch, dict[tuple[str, int], Counter]], Iterator[None]]):
    """A mapInArrow function: ``each`` adds a batch's rows to the counts and yields now and then."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Gathered()
        for batch in batches:
            for _ in each(batch, held.counts):
                if held.full():
                    yield held.taken()
        yield held.taken()

    return run


def _hashes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words of a text, eight bytes at a time; of the rare long ones, one by one."""
    blocks = np.ndarray(len(text) + 1, "<u8", text + bytes(8), strides=(1,))
    sizes = ends - starts
    out = sizes.astype(np.uint64)
    for done in range(0, min(int(sizes.max(initial=0)), LONG), 8):
        at = np.flatnonzero(sizes > done)
        left = np.minimum(sizes[at] - done, 8).astype(np.uint64)
        part = (out[at] ^ (blocks[starts[at] + done] << (np.uint64(64) - np.uint64(8) * left))) * np.uint64(0x9E3779B97F4A7C15)
        out[at] = part ^ (part >> np.uint64(32))
    for i in np.flatnonzero(sizes > LONG).tolist():
        out[i] = xxhash.xxh64_intdigest(text[starts[i]:ends[i]], 42)
    return out


def _codes(hashes: np.ndarray, size: int, lang: bytes) -> np.ndarray:
    """A 64-bit hash of the phrase of ``size`` words at each position, from its words' hashes."""
    at = np.full(max(len(hashes) - size + 1, 0), xxhash.xxh64_intdigest(lang, size), np.uint64)
    for i in range(size):
        at = at * np.uint64(0x9E3779B97F4A7C15) + hashes[i:len(hashes) - size + 1 + i]
    at ^= at >> np.uint64(31)
    return at * np.uint64(0xBF58476D1CE4E5B9)


class Frequent:
    """The Bloom filter of a level's phrases, asked for all positions of a text at once."""

    def __init__(self, bits: int, array: bytes) -> None:
        self.bits, self.array = bits, np.frombuffer(array, np.uint8)

    def _has(self, codes: np.ndarray, probe: int) -> np.ndarray:
        at = (codes >> np.uint64(probe) & np.uint64((1 << CHOOSE) - 1)) % np.uint64(self.bits)
        return (self.array[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

    def has(self, codes: np.ndarray) -> np.ndarray:
        found = self._has(codes, PROBES[0])
        for probe in PROBES[1:]:
            at = np.flatnonzero(found)
            found[at] = self._has(codes[at], probe)
        return found

    def __call__(self, hashes: np.ndarray, size: int, lang: bytes) -> np.ndarray:
        return self.has(_codes(hashes, size, lang))


def _filter(codes: DataFrame, n: int) -> Frequent:
    """The filter of ``n`` codes; a driver value of MOST_BITS / 8 bytes at most."""
    bits = min(max(1, -(-n * FILTER_BITS // BUCKET)) * BUCKET, MOST_BITS)
    at = F.explode(F.array([F.shiftrightunsigned("code", x).bitwiseAND(F.lit((1 << CHOOSE) - 1)) % bits for x in PROBES]))
    rows = (codes.select(at.alias("at"))
            .select((F.col("at") / BUCKET).cast("int").alias("bucket"), (F.col("at") % BUCKET).alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    array = bytearray(bits // 8)
    for r in rows:
        array[r.bucket * BUCKET // 8:(r.bucket + 1) * BUCKET // 8] = r.bits
    return Frequent(bits, bytes(array))


def _packed(counted: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """Partial counts as one row for each part: few rows are moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in counted(batches):
            if "code" in batch.schema.names:
                code = batch.column("code").to_numpy().view(np.uint64)
            else:
                ends = np.cumsum(pc.binary_length(batch.column("phrase")).to_numpy())
                starts = np.append(0, ends[:-1])
                code = _codes(_hashes(b"".join(_bytes(batch.column("phrase"))), starts, ends), 1, b"")
            part = (code >> np.uint64(64 - PART_BITS)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            batch, part = batch.take(pa.array(order)), part[order]
            cut = np.flatnonzero(np.diff(part, prepend=-1, append=1 << PART_BITS))
            rows = [batch.slice(a, b - a).serialize().to_pybytes() for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(part[cut[:-1]]), pa.array(rows, pa.binary())], ["part", "rows"])

    return run


def _merged(schema: pa.Schema, least: int):
    """What one part's partial counts add up to, from ``least`` on."""

    def run(packed: pa.Table) -> pa.Table:
        rows = pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(x), schema) for x in packed.column("rows").to_pylist()])
        out = rows.group_by(schema.names[:-1], use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})
        return out.filter(pc.greater_equal(out.column("n"), least)).select(schema.names)

    return run


def _totals(of: DataFrame, counted, schema: pa.Schema, least: int = 1) -> DataFrame:
    return (of.mapInArrow(_packed(counted), "part int, rows binary").groupBy("part")
            .applyInArrow(_merged(schema, least), from_arrow_schema(schema)))


def _bytes(column: pa.Array) -> np.ndarray:
    return column.cast(pa.binary()).to_numpy(zero_copy_only=False)


class Texts:
    """The words of all rows of one language, one row after the other; a row is a chunk, or a piece of a text."""

    def __init__(self, text: bytes, ends: np.ndarray, left: np.ndarray, own: np.ndarray, n: np.ndarray | None) -> None:
        self.text, self.ends, self.n = text, ends, n         # of each word, how often its row is there (None: once)
        self.starts = np.append(0, ends[:-1] + 1)
        self.left = left                                     # words from here to the end of the row
        self.own = own                                       # of them, how many begin the row's own phrases; below 1 none

    @classmethod
    def of_chunks(cls, batch: pa.RecordBatch) -> Texts:
        own, length = batch.column("number").to_numpy(), pc.count_substring(batch.column("phrase"), " ").to_numpy() + 1
        text = b" ".join(_bytes(batch.column("phrase")))
        ends = np.append(np.flatnonzero(np.frombuffer(text, np.uint8) == 32), len(text))
        first, at = np.cumsum(length) - length, np.arange(len(ends))
        return cls(text, ends, np.repeat(first + length, length) - at, np.repeat(first + own, length) - at,
                   np.repeat(batch.column("n").to_numpy(), length))

    @classmethod
    def of_pieces(cls, plain: bytes) -> Texts | None:
        """The words of the lines of a plain text that ends with a line's end; None where there is no word."""
        chars = np.frombuffer(plain, np.uint8)
        line = chars == 10
        gap = line | (chars == 32)
        kept = ~gap
        kept[1:] |= kept[:-1] & gap[1:]                      # each word and one gap behind it
        ended = np.flatnonzero(kept & gap)
        if not len(ended):
            return None
        chars, ends = chars[kept], np.flatnonzero(gap[kept])
        chars[ends] = 32
        lines = np.searchsorted(ended, np.flatnonzero(line), side="right")
        length = np.diff(lines, prepend=0)
        left = np.repeat(lines, length) - np.arange(len(ends))
        return cls(chars[:-1].tobytes(), ends, left, left, None)

    @cached_property
    def hashes(self) -> np.ndarray:
        return _hashes(self.text, self.starts, self.ends)

    def begin(self, size: int) -> np.ndarray:
        """Whether one of its row's own phrases of ``size`` words begins at a position; of as many as can have one."""
        return ((self.left >= size) & (self.own > 0))[:max(len(self.left) - size + 1, 0)]

    def phrases(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """The phrases from one word to another."""
        return list(map(self.text.__getitem__, map(slice, self.starts[first].tolist(), self.ends[last].tolist())))

    def times(self, at: np.ndarray) -> np.ndarray:
        return np.ones(len(at), np.int64) if self.n is None else self.n[at]


def _slices(texts: Iterable[bytes]) -> Iterator[bytes]:
    """Plain texts as lines, about SLICE bytes at a time; a piece stays whole."""
    held, size = [], 0
    for text in texts:
        plain, at = text.translate(PLAIN), 0
        while at < len(plain):
            to = len(plain)
            if to - at > SLICE:
                to = plain.rfind(b"\n", at, at + SLICE) + 1 or plain.find(b"\n", at + SLICE) + 1 or to
            held.append(plain[at:to])
            size, at = size + to - at, to
            if size >= SLICE:
                yield b"\n".join([*held, b""])
                held, size = [], 0
    if held:
        yield b"\n".join([*held, b""])


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, Texts]]:
    """The rows of a batch by language: chunks, or texts (a column ``text``) by slices."""
    langs = batch.column("lang").dictionary_encode()
    order = np.argsort(langs.indices.to_numpy(), kind="stable")
    batch, at = batch.take(pa.array(order)), 0
    for lang, size in zip(langs.dictionary.to_pylist(), np.bincount(langs.indices.to_numpy()).tolist()):
        rows = batch.slice(at, size)
        if "text" in batch.schema.names:
            yield from ((lang, t) for t in map(Texts.of_pieces, _slices(_bytes(rows.column("text")))) if t)
        else:
            yield lang, Texts.of_chunks(rows)
        at += size


def _add(into: Counter, phrases: list[bytes], ns: np.ndarray) -> None:
    """Count phrases, each so many times; most count once."""
    into.update([p for p, n in zip(phrases, ns.tolist()) if n == 1])
    for i in np.flatnonzero(ns != 1).tolist():
        into[phrases[i]] += int(ns[i])


def _words(batch, counts):
    """Every word."""
    for lang, t in _texts(batch):
        _add_words(counts[lang, 1], t, t.begin(1))
        yield


def _add_words(into: Counter, t: Texts, where: np.ndarray) -> None:
    """Count the words at some positions, summed before they are added."""
    words = pc.split_pattern(pa.array([t.text], pa.binary()), " ").values.filter(pa.array(where)).dictionary_encode()
    ns = np.zeros(len(words.dictionary), np.int64)
    if t.n is None:
        ns += np.bincount(words.indices.to_numpy(), minlength=len(ns))
    else:
        np.add.at(ns, words.indices.to_numpy(), t.n[where])
    _add(into, words.dictionary.to_numpy(zero_copy_only=False).tolist(), ns)


def _count(size: int, held, most: int = 0):
    """Phrases of ``size`` to ``most`` words that ``held`` lets through, filters by size (None: all that are there)."""

    def each(batch, counts):
        for lang, t in _texts(batch):
            for k in range(size, max(size, most) + 1):
                fits = t.begin(k)
                if held is not None:
                    fits &= held[k].value(t.hashes, k, lang.encode())
                at = np.flatnonzero(fits)
                _add(counts[lang, k], t.phrases(at, at + k - 1), t.times(at))
            yield

    return _gathering(each)


def _hashed(size: int, below=None):
    """Codes of the phrases of ``size`` words whose two parts ``below`` lets through (None: of all) with partial counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, ns, held = [], [], 0
        for batch in batches:
            for lang, t in _texts(batch):
                fits = t.begin(size)
                if below is not None and len(fits):
                    good = below.value(t.hashes, size - 1, lang.encode())
                    fits &= good[:-1] & good[1:]
                at = np.flatnonzero(fits)
                codes.append(_codes(t.hashes, size, lang.encode())[at])
                ns.append(None if t.n is None else t.n[at])
                held += len(at)
                if held > CODES_HELD:
                    yield _summed(codes, ns)
                    codes, ns, held = [], [], 0
        if held:
            yield _summed(codes, ns)

    return run


def _summed(codes: list[np.ndarray], ns: list[np.ndarray | None]) -> pa.RecordBatch:
    """Codes in order, each once, and their counts (None: one each)."""
    code, once = np.concatenate(codes), all(x is None for x in ns)
    if once:
        code.sort()
    else:
        n = np.concatenate([np.ones(len(c), np.int64) if x is None else x for c, x in zip(codes, ns)])
        order = np.argsort(code)
        code, n = code[order], n[order]
    first = np.flatnonzero(np.concatenate([[len(code) > 0], code[1:] != code[:-1]]))
    n = np.diff(first, append=len(code)) if once else np.add.reduceat(n, first) if len(code) else n
    return pa.RecordBatch.from_arrays([pa.array(code[first].view(np.int64)), pa.array(n)], ["code", "n"])


def _dictionary(w: int, trigger: int, held: dict[int, Broadcast]):
    """Texts to the chunks of their runs of frequent pairs; ``number`` is how many phrases of a length begin in a chunk and
    are its own. Rows of number 0 are the words that ``held`` lets through, and all words as an empty phrase."""

    def each(batch, counts):
        for lang, t in _texts(batch):
            code = lang.encode()
            good = held[1].value(t.hashes, 1, code)
            _add_words(counts[lang, 0], t, good)
            counts[lang, 0][b""] += len(good)
            if 2 in held:
                pair = t.begin(2) & good[:-1] & good[1:]
                at = np.flatnonzero(pair)
                pair[at] = held[2].value.has(_codes(t.hashes, 2, code)[at])
                # pairs [start, end), words [start, end]
                start, end = np.flatnonzero(np.diff(np.concatenate([[0], pair, [0]]))).reshape(-1, 2).T
                length = end + 1 - start
                for size in np.unique(length).tolist():
                    at = np.flatnonzero(length == size)
                    runs = t.phrases(start[at], end[at])
                    if size <= WHOLE:
                        counts[lang, size].update(runs)
                    else:
                        for chunk, own in [c for run in runs for c in chunks(run.split(b" "), w, trigger)]:
                            counts[lang, own][chunk] += 1
            yield

    return _gathering(each)


def counts(spark: SparkSession, docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
           lang_col: str = "lang", text_col: str = "text", trigger: int = TRIGGER) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to ``max_words`` words that occur ``min_count`` times: (lang, phrase, number, n); and (lang, n) of all words."""
    w = max(max_words - 1, 1)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def frequent(of: DataFrame, size: int, below=None) -> Broadcast:
        """The filter of the phrases of ``size`` words that occur ``min_count`` times, by their hashes."""
        codes = materialise(spark, _totals(of, _hashed(size, below), CODES, min_count), f"phrases-codes-{size}")
        return spark.sparkContext.broadcast(_filter(codes, codes.count()))

    held = {1: frequent(texts, 1)}
    if max_words > 1:
        held[2] = frequent(texts, 2, held[1])
    parsed = materialise(spark, _totals(texts, _dictionary(w, trigger, held), GATHERED), "phrases-dictionary")
    totals = parsed.where("number = 0 and phrase = ''").groupBy("lang").agg(F.sum("n").alias("total"))
    levels = [parsed.where("number = 0 and phrase <> ''").withColumn("number", F.lit(1)).where(F.col("n") >= min_count)]
    if max_words > 1:
        parsed = parsed.where("number > 0")
        for size in range(3, max_words + 1):
            held[size] = frequent(parsed, size, held[size - 1])
        levels.append(materialise(spark, _totals(parsed, _count(2, held, max_words), GATHERED, min_count), "phrases-found"))
    for x in held.values():
        x.unpersist()
    return reduce(DataFrame.unionByName, levels), totals


def _score(a: str, total: str, left: str, right: str) -> Column:
    """floor(1000 * a * n / (l * r)) in whole numbers of 38 digits."""
    wide = lambda c: f"cast({c} as decimal(19, 0))"
    return F.expr(f"(({wide(f'1000 * {a}')} * {wide(total)}) div ({wide(left)} * {wide(right)}))").cast("long")


def mine(spark: SparkSession, docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
         per_lang: int = PER_LANG, covered: int = COVERED, lang_col: str = "lang", text_col: str = "text",
         trigger: int = TRIGGER) -> DataFrame:
    """The best phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    A phrase's score is that of its lowest-scoring cut into two parts, ties to the
    shortest first part. A phrase goes if a longer one holds ``covered`` percent of
    its occurrences; as counts only fall with length, the phrases that are one word longer decide.
    """
    found, totals = counts(spark, docs, min_count, max_words, lang_col, text_col, trigger)
    part = found.select("lang", F.col("phrase").alias("part"), F.col("n").alias("n_part"))
    words, size = F.split("phrase", " "), F.col("number")
    cand = found.where("number > 1").select("lang", "phrase", "number", F.col("n").alias("a"), words.alias("w"))
    cuts = (cand.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
            .select("lang", "phrase", "a", "k",
                    F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
                    F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("right")))
    cuts = (cuts.join(part.withColumnsRenamed({"part": "left", "n_part": "l"}), ["lang", "left"])
            .join(part.withColumnsRenamed({"part": "right", "n_part": "r"}), ["lang", "right"])
            .join(totals, "lang"))
    best = (cuts.withColumn("score", _score("a", "total", "l", "r"))
            .groupBy("lang", "phrase", "a", F.col("total").alias("n"))
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    within = F.array(F.array_join(F.slice("w", F.lit(1), size - 1), " "), F.array_join(F.slice("w", F.lit(2), size - 1), " "))
    longer = (cand.where("number > 2").select("lang", "a", F.explode(within).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longest")))
    kept = (best.join(longer, ["lang", "phrase"], "left")
            .where(F.col("longest").isNull() | (100 * F.col("longest") < covered * F.col("a"))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (kept.select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_lang)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
