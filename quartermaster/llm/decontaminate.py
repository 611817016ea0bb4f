"""Benchmark decontamination by spaced-seed hashing.

Fixed masks slide over the tokens of test items and of training documents. A mask
hashes the tokens under its 1s and ignores those under its 0s, so a changed word
under a 0 leaves the hash as it is. Equal hashes of a document and an item are
hits; a hit's diagonal is then verified token by token: the best ungapped stretch
(+1 for an equal token, ``MISMATCH`` for another) has to hold ``NEEDED`` equal
tokens, or three quarters of a shorter item. The masks go by the item's length, and
are chosen so that no such stretch escapes them: each sequence of equal and changed
tokens that the verification accepts holds one whole mask (the tests enumerate them).

The items are the stated query set: they are taken in blocks of bounded size, and
each block's sorted hash arrays go to the tasks that scan the documents. Nothing
of the documents is shuffled, and documents are whole however long they are.

Tokens are runs of letters and digits of the lower-cased text; anything beyond
ASCII counts as a letter but for the common punctuation ranges.

Defined cases: a null or empty text, or one without tokens, is clean; an item
of fewer than ``SEEDED`` tokens is found where all of its tokens stand as they are, and
``clean`` drops a document for such an item only if it is the whole document, for
a few words alone are no leak; an empty benchmark or
table gives an empty result; repeated items report under each of their ids and
repeated documents row by row; extra columns are ignored, or kept by ``clean``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# By the least length of the items that they are for. A stretch that is accepted has no start
# of a sum below 0, so its first twelve equal tokens lie among twenty: no longer one adds a case.
MASKS = (
    (5, ("1111", "11101", "11011")),
    (6, ("11111", "111101", "111011", "110111", "1101011", "1111001", "11011001", "11100101")),
    (12, ("111011", "1101011", "1101101", "1110011", "11101001", "11110001", "110110001", "111000101")),
)
SEEDED = 5                    # tokens from which changes are tolerated; shorter items are searched for as they are
NEEDED = 12                   # equal tokens that make a leak
MISMATCH = -1.5
BLOCK_CHARS = 4_000_000       # text of the items that one pass holds
CHUNK_CHARS = 2_000_000       # documents are searched together up to this size
SLICE_BYTES = 1 << 21         # bytes that are hashed at once

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_PUNCTUATION = re.compile("[\\u00a0-\\u00bf\\u2000-\\u206f\\u2e00-\\u2e7f\\u3000-\\u303f\\ufeff]")
_IS_TOKEN = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to n of the odd base and of its inverse, modulo 2^64."""
    one = np.ones(1, np.uint64)
    return tuple(np.concatenate([one, np.cumprod(np.full(n, base, np.uint64))]) for base in (_ODD, _INVERSE))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def token_hashes(texts: list[str | None], powers=None) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every token, bounds): text k has the tokens bounds[k]:bounds[k + 1]."""
    powers = powers or _powers(SLICE_BYTES)
    data, sizes = [], []
    for t in texts:
        t = (t or "").lower()
        if not t.isascii():
            t = _PUNCTUATION.sub(" ", t)
        data.append(t.encode("utf-8", "surrogatepass") + b"\n")
        sizes.append(len(data[-1]))
    buf = np.frombuffer(b"".join(data), np.uint8)
    edges = np.flatnonzero(np.diff(_IS_TOKEN[buf].view(np.int8), prepend=0))     # every text ends outside a token
    starts, ends = edges[::2], edges[1::2]
    hashes = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):                             # the tokens of one slice of bytes, a longer one alone
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE_BYTES, "right")))
        low = starts[i]
        part = buf[low:ends[j - 1]].astype(np.uint64) + np.uint64(1)
        power, inverse = powers if len(part) < len(powers[0]) else _powers(len(part))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * power[:len(part)])])
        hashes[i:j] = (sums[ends[i:j] - low] - sums[starts[i:j] - low]) * inverse[starts[i:j] - low]
        i = j
    return _mix(hashes), np.concatenate([[0], np.searchsorted(starts, np.cumsum(sizes))])


def _windows(h: np.ndarray, mask: str, seed: int) -> np.ndarray:
    """The hash of the tokens under the mask's 1s, at every position where the mask fits."""
    n = len(h) - len(mask) + 1
    out = np.full(max(n, 0), seed, np.uint64)
    if n > 0:
        for i in (i for i, c in enumerate(mask) if c == "1"):
            out += h[i:i + n] * np.uint64((2 * seed + 1) * pow(_ODD, i + 1, 1 << 64) % (1 << 64) | 1)
    return out


class Index:
    """Sorted hashes of the items' windows, with the item and position of each."""

    def __init__(self, ids: list, texts: list[str], masks=MASKS, seeded: int = SEEDED, needed: int = NEEDED):
        self.ids, self.needed, self.seeded = ids, needed, seeded
        h, bounds = token_hashes(texts)
        self.items = [h[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        self.seeds: list[tuple[str, int]] = []          # (mask, seed)
        self.sizes = np.array([len(x) for x in self.items], np.int64)
        hashes, items, at = [], [], []
        number = {}
        for k, item in enumerate(self.items):
            if not len(item):
                continue
            short = len(item) < seeded
            for mask in ("1" * len(item),) if short else max((n, group) for n, group in masks if n <= len(item))[1]:
                if len(mask) > len(item):
                    continue
                seed = number.setdefault(mask, len(number) + 1)
                if seed > len(self.seeds):
                    self.seeds.append((mask, seed))
                w = _mix(_windows(item, mask, seed))
                hashes.append(w)
                items.append(np.full(len(w), k))
                at.append(np.arange(len(w)))
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        h, items, at = join(hashes, np.uint64), join(items, np.int64), join(at, np.int64)
        order = np.argsort(h, kind="stable")
        self.hashes, self.item, self.at = h[order], items[order], at[order]
        bits = min(26, max(10, int(16 * len(h) + 1).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.there = np.zeros(1 << bits, bool)          # which leading bits occur; most windows end here
        self.there[self.hashes >> self.shift] = True

    @classmethod
    def of(cls, arrays: dict) -> Index:
        """The index whose ``vars`` were broadcast (plain arrays, so that any worker can read them)."""
        index = cls.__new__(cls)
        index.__dict__.update(arrays)
        return index

    def search(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, first token, token after the last, equal tokens): the best stretch of each pair."""
        powers = _powers(SLICE_BYTES)
        chunk, size, first = [], 0, 0
        for i, t in enumerate(texts):
            if chunk and size + len(t or "") > CHUNK_CHARS:
                yield from self._search(chunk, first, powers)
                chunk, size, first = [], 0, i
            chunk.append(t)
            size += len(t or "")
        if chunk:
            yield from self._search(chunk, first, powers)

    def leaky(self, texts: list[str | None]) -> set[int]:
        """The texts that hold an item; of the short items, those that are nothing else."""
        found, lengths = set(), {}
        for text, item, start, end, _ in self.search(texts):
            if self.sizes[item] < self.seeded:
                if text not in lengths:
                    lengths[text] = len(token_hashes([texts[text]])[0])
                if end - start != lengths[text]:
                    continue
            found.add(text)
        return found

    def _search(self, texts, first, powers):
        h, bounds = token_hashes(texts, powers)
        found = set()
        for mask, seed in self.seeds:
            w = _mix(_windows(h, mask, seed))
            hits = np.flatnonzero(self.there[w >> self.shift])
            left = np.searchsorted(self.hashes, w[hits], "left")
            count = np.searchsorted(self.hashes, w[hits], "right") - left
            hits, left, count = hits[count > 0], left[count > 0], count[count > 0]
            text = np.searchsorted(bounds, hits, "right") - 1
            inside = hits + len(mask) <= bounds[text + 1]
            hits, left, count, text = hits[inside], left[inside], count[inside], text[inside]
            if len(hits):
                entry = np.repeat(left - np.cumsum(count) + count, count) + np.arange(count.sum())
                diagonal = np.repeat(hits, count) - self.at[entry]
                text, item = np.repeat(text, count), self.item[entry]
                if "0" not in mask and len(mask) < self.seeded:
                    # a short item as it is: its first place in a text tells all
                    whole = self.sizes[item] == len(mask)
                    _, one = np.unique(text[whole] * len(self.items) + item[whole], return_index=True)
                    keep = np.concatenate([np.flatnonzero(~whole), np.flatnonzero(whole)[one]])
                    text, item, diagonal = text[keep], item[keep], diagonal[keep]
                found.update(zip(text.tolist(), item.tolist(), diagonal.tolist()))
        best = {}
        for text, k, diagonal in found:
            hit = self._verify(h, bounds[text], bounds[text + 1], self.items[k], diagonal)
            if hit and hit > best.get((text, k), (0,)):
                best[text, k] = hit
        for (text, k), (equal, start, end) in sorted(best.items()):
            yield first + text, k, int(-start - bounds[text]), int(end - bounds[text]), equal

    def _verify(self, h, low, high, item, diagonal):
        """(equal tokens, -start, end) of the diagonal's best stretch, or None if it is no leak."""
        a, b = max(low, diagonal), min(high, diagonal + len(item))
        same = h[a:b] == item[a - diagonal:b - diagonal]
        total = np.concatenate([[0.0], np.cumsum(np.where(same, 1.0, MISMATCH))])
        gain = total - np.minimum.accumulate(total)
        end = int(gain.argmax())
        start = int(total[:end + 1].argmin())
        equal = int(same[start:end].sum())
        least = len(item) if len(item) < self.seeded else min(self.needed, -(-3 * len(item) // 4))
        return (equal, -(a + start), a + end) if equal >= least else None


def blocks(spark: SparkSession, items: DataFrame, id_col: str = "item_id", text_col: str = "text",
           block_chars: int = BLOCK_CHARS) -> Iterator:
    """The broadcast arrays of an Index of each block of items, of about ``block_chars`` characters."""
    base = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    total = base.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars)
    for k in range(n):
        rows = base.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()
        yield spark.sparkContext.broadcast(vars(Index([r.id for r in rows], [r.text for r in rows])))


def leaks(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, item, first_token, end_token, n_equal): one row for each document row and item that it holds."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kinds = base.schema["id"].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"id {kinds[0]}, item {kinds[1]}, first_token bigint, end_token bigint, n_equal bigint"

    def finder(arrays):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index.of(arrays.value)
            for batch in batches:
                found = list(index.search(batch.column("text").to_pylist()))
                if found:
                    text, item, *numbers = zip(*found)
                    ids = [index.ids[k] for k in item]
                    cols = [batch.column("id").take(pa.array(text, pa.int64())), pa.array(ids),
                            *[pa.array(x, pa.int64()) for x in numbers]]
                    yield pa.RecordBatch.from_arrays(cols, ["id", "item", "first_token", "end_token", "n_equal"])
        return run

    out = spark.createDataFrame([], schema)
    for arrays in blocks(spark, items, item_id, item_text, block_chars):
        out = out.unionByName(base.mapInArrow(finder(arrays), schema))
    return out.toDF(id_col, item_id, "first_token", "end_token", "n_equal")


def clean(spark: SparkSession, docs: DataFrame, items: DataFrame, text_col: str = "text",
          item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows, with all their columns, whose text holds no item; each row is judged where it is."""

    def verdict(arrays):
        @F.pandas_udf("boolean")
        def leaky(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            index = Index.of(arrays.value)
            for texts in batches:
                out = np.zeros(len(texts), bool)
                out[list(index.leaky(texts.tolist()))] = True
                yield pd.Series(out)
        return leaky

    for arrays in blocks(spark, items, item_id, item_text, block_chars):
        docs = docs.where(~verdict(arrays)(F.col(text_col)))
    return docs
