"""Phrase mining against a plain count of every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quartermaster.llm import phrases as P


def plain(rows, min_count, per_lang, max_words=5, covered=100):
    """(lang, rank, phrase, a, l, r, n, score) by counting each phrase where it stands."""
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang, " ".join(words[i:i + k])) for i in range(len(words) - k + 1))
    cand = {k: a for k, a in f.items() if a >= min_count and " " in k[1]}
    best = {}
    for (lang, phrase), a in cand.items():
        if any(x == lang and f" {phrase} " in f" {y} " and y != phrase and 100 * b >= covered * a for (x, y), b in cand.items()):
            continue
        w, n = phrase.split(" "), total[lang]
        cuts = []
        for k in range(1, len(w)):
            left, right = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            cuts.append((1000 * a * n // (left * right), k, left, right))
        s, _, left, right = min(cuts)
        best.setdefault(lang, []).append((-s, -a, phrase.encode(), phrase, a, left, right, n, s))
    return sorted((lang, i + 1, *x[3:]) for lang, xs in best.items() for i, x in enumerate(sorted(xs)[:per_lang]))


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["the", "of", "a", "Big", "cat", "dog", "été", "漢字", "x y", " "]
    rows = [(rng.choice(["en", "en", "de", None]), "".join(
        rng.choice(words) + rng.choice([" ", " ", "\t", "  ", ", ", ".\n", "; "]) for _ in range(rng.randrange(80)))) for _ in range(n)]
    return rows + [("en", "one of the Big cats sat on the mat again and again and never left it there at all today " * 3)] * 5


@pytest.mark.parametrize("seed,trigger,whole", [(0, 3, 4), (1, 1, 0)])
def test_equals_a_plain_count(spark, monkeypatch, seed, trigger, whole):
    chunks = P.chunks
    monkeypatch.setattr(P, "chunks", lambda words, w, t: chunks(words, w, t, whole))
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = P.mine(spark, df, min_count=4, per_lang=40, trigger=trigger)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 4, 40)


@pytest.mark.parametrize("w", [1, 2, 4])
def test_every_phrase_belongs_to_one_chunk(w):
    rng = random.Random(w)
    for n in (0, 1, 3, 17, 18, 200):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(n)]
        got = Counter()
        for chunk, own in P.chunks(words, w, 2):
            c = chunk.split(b" ")
            for k in range(1, w + 2):
                got.update(tuple(c[i:i + k]) for i in range(min(own, len(c) - k + 1)))
        assert got == Counter(tuple(words[i:i + k]) for k in range(1, w + 2) for i in range(n - k + 1))


def test_copies_and_a_very_long_text(spark):
    rows = [("en", "same old story told again")] * 500 + [("en", "for " * 300_000)] + [("en", None), (None, ""), ("und", "!!!")]
    got = P.mine(spark, spark.createDataFrame(rows, "lang string, text string"), min_count=400, per_lang=10).collect()
    assert {r.phrase for r in got} == {"same old story told again", *[" ".join(["for"] * k) for k in range(2, 6)]}
    assert {r.phrase: r.a for r in got}["for for"] == 299_999
    assert {r.n for r in got} == {2500 + 300_000}


def test_products_beyond_64_bits_are_exact(spark):
    df = spark.createDataFrame([(10**12, 10**13 + 7, 10**12 + 9, 3 * 10**12 + 1)], "a long, n long, l long, r long")
    assert df.select(P._score("a", "n", "l", "r")).first()[0] == 1000 * 10**12 * (10**13 + 7) // ((10**12 + 9) * (3 * 10**12 + 1))


def test_empty_tables_and_extra_columns(spark):
    df = spark.createDataFrame([], "lang string, text string, phrase string, n int, a int")
    assert P.mine(spark, df).collect() == []
    one = spark.createDataFrame([("en", "a b a b a b", "x", 1, 2)] * 3, "lang string, text string, phrase string, n int, a int")
    assert [tuple(r) for r in P.mine(spark, one, min_count=3).collect()] == plain([("en", "a b a b a b")] * 3, 3, 2000)


def chunk_rows(rows):
    return pa.RecordBatch.from_pylist([dict(zip(("lang", "phrase", "number", "n"), r)) for r in rows], pa.schema(
        [("lang", pa.string()), ("phrase", pa.string()), ("number", pa.int32()), ("n", pa.int64())]))


def test_words_are_hashed_together_and_summed_once(monkeypatch):
    batch = chunk_rows([("en", " ".join(f"word{i}x{k}" for k in range(20)), 16, 1) for i in range(200)])
    single, summed = [], []
    digest, crc32 = P.xxhash.xxh64_intdigest, P.zlib.crc32
    monkeypatch.setattr(P.xxhash, "xxh64_intdigest", lambda *a: single.append(a) or digest(*a))
    monkeypatch.setattr(P.zlib, "crc32", lambda x: summed.append(len(x)) or crc32(x))
    [codes] = P._hashed(20)(iter([batch]))
    assert len(set(codes.column("code").to_pylist())) == 200
    assert len(single) < 10                                  # 4,000 different words
    words = [b"word%d" % i for i in range(1000)]
    assert len(P.chunks(words, 4, 8)) > 50
    assert sum(summed) == sum(map(len, words))               # not once for each window a word is in


def test_a_hash_is_the_words_alone():
    rng = random.Random(5)
    words = [bytes(rng.choice(b"ab\xc3\xa9") for _ in range(n)) for n in [*range(1, 140), 5000] for _ in range(3)] * 2
    rng.shuffle(words)
    ends = np.cumsum([len(x) + 1 for x in words]) - 1
    found = P._hashes(b" ".join(words), ends - np.array([len(x) for x in words]), ends).tolist()
    assert len(set(zip(words, found))) == len(set(words)) == len(set(found))


def test_rows_of_several_languages_count_what_they_own():
    # the second row's last two words are the next chunk's to count
    batch = chunk_rows([("de", "a b c", 3, 2), ("en", "a b c d", 2, 1), ("de", "a b", 2, 5), ("en", "x", 1, 3)])

    def found(each):
        return sorted((r["lang"], r["phrase"], r["n"]) for out in each(iter([batch])) for r in out.to_pylist())

    assert found(P._gathering(P._words)) == [
        ("de", "a", 7), ("de", "b", 7), ("de", "c", 2), ("en", "a", 1), ("en", "b", 1), ("en", "x", 3)]
    assert found(P._count(2, None)) == [("de", "a b", 7), ("de", "b c", 2), ("en", "a b", 1), ("en", "b c", 1)]
    assert found(P._count(3, None)) == [("de", "a b c", 2), ("en", "a b c", 1), ("en", "b c d", 1)]


def test_a_dictionary_holds_no_rare_words(spark, monkeypatch):
    kept, materialise = {}, P.materialise

    def recorded(spark, df, name):
        kept[name] = materialise(spark, df, name)
        return kept[name]

    monkeypatch.setattr(P, "materialise", recorded)
    rows = [("en", f"all of us said r{i}x r{i}y r{i}z and r{i}v went home") for i in range(300)]
    got = P.mine(spark, spark.createDataFrame(rows, "lang string, text string"), min_count=20, per_lang=40)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 20, 40)
    held = kept["phrases-dictionary"].collect()
    assert {r.phrase for r in held if r.number} == {"all of us said", "went home"}            # not a row for each text
    assert {(r.phrase, r.n) for r in held if not r.number} == {("", 300 * 11), *[(x, 300) for x in "all of us said and went home".split()]}


def test_a_filter_lets_all_of_its_own_and_few_others_through(spark):
    codes = np.random.default_rng(7).integers(-2**63, 2**63 - 1, 60_000)
    held = P._filter(spark.createDataFrame(pa.table({"code": codes[:10_000]})), 10_000)
    assert held.has(codes[:10_000].view(np.uint64)).all()
    assert held.has(codes[10_000:].view(np.uint64)).mean() < 0.01


def test_codes_are_moved_as_few_rows_and_summed_exactly():
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 2000, "text": [f"w{i % 977} w{i % 13} w{i}" for i in range(2000)]})
    out = list(P._packed(P._hashed(1))(iter([batch])))
    assert sum(x.num_rows for x in out) <= 1 << P.PART_BITS
    found = P._merged(P.CODES, 2)(pa.Table.from_batches(out)).column("code").to_pylist()
    seen = Counter(w for t in batch.column("text").to_pylist() for w in t.split())
    want = {w: P._codes(P._hashes(w.encode(), np.array([0]), np.array([len(w)])), 1, b"en").view(np.int64)[0] for w in seen}
    assert set(found) == {c for w, c in want.items() if seen[w] >= 2} and len(found) == len(set(found))


@pytest.mark.parametrize("size", [1, 40, 1 << 21])
def test_texts_are_cut_between_pieces_only(monkeypatch, size):
    monkeypatch.setattr(P, "SLICE", size)
    texts = ["", " ", "A b\tc  d,e f.\n\n g", "one two three four five six seven eight nine ten eleven; x", "été\x1cb \x0b\x0c\r  漢字\xa0z", "!!!", "end"]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})
    got = []
    for _, t in P._texts(batch):
        words, at = t.text.split(b" "), 0
        while at < len(words):
            got.append(words[at:at + int(t.left[at])])
            at += int(t.left[at])
    assert got == [p.split() for x in texts for p in x.encode().translate(P.PLAIN).split(b"\n") if p.split()]
