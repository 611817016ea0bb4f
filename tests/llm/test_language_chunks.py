"""Language ID in chunks without borders or large arrays, and the whole query, counts included, against plain loops."""

import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartermaster.llm import langid, ranker
from quartermaster.llm.queries import LLM_QUERIES

LETTERS = langid._letters()


def grams(texts):
    return np.concatenate([np.zeros(0, np.uint64), *[
        langid.gram_keys(group, LETTERS, edges)[0] for _, group, edges in langid.pieces(texts)]]).tolist()


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 50])
def test_chunks_have_no_borders(monkeypatch, chunk):
    rng = random.Random(chunk)
    texts = ["".join(rng.choices("abcΣİ𠀀 .1\n", k=rng.randint(0, 90))) for _ in range(60)] + [None, "", "   ", "a" * 99]
    whole = [grams([t]) for t in texts]
    monkeypatch.setattr(langid, "CHUNK_CHARS", chunk)
    assert [grams([t]) for t in texts] == whole
    assert sorted(grams(texts)) == sorted(k for g in whole for k in g)


def test_memory_does_not_grow_with_the_languages():
    rng = random.Random(1)
    known = [np.unique(langid.gram_keys(["".join(rng.choices("abcdefgh ", k=300))], LETTERS)[0], return_counts=True)
             for _ in range(200)]
    model = langid.Model([f"l{i:03d}" for i in range(200)], known)
    text = "".join(rng.choices("abcdefgh ", k=1000)) * 1000
    tracemalloc.start()
    entropy, _ = model.entropies([text], LETTERS)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 300e6
    parts, _ = model.entropies([text[:1000]], LETTERS)
    assert np.allclose(entropy, parts, atol=0.02)


class PlainModel:
    """Interpolated Kneser-Ney by its definition, with dictionaries of strings."""

    def __init__(self, texts):
        counts = Counter(g for t in texts for g in plain_grams(t))
        self.levels = []
        for order in range(langid.ORDER, 0, -1):
            ones, twos = (sum(n == k for n in counts.values()) for k in (1, 2))
            context, types = defaultdict(int), Counter()
            for g, n in counts.items():
                context[g[:-1]] += n
                types[g[:-1]] += 1
            self.levels.append((counts, context, types, ones / (ones + 2 * twos) if ones and twos else 0.75))
            counts = Counter(g[1:] for g in counts)
        self.chars = {g[-1] for g in self.levels[0][0]}

    def p(self, gram, floor, level=0):
        if level == langid.ORDER:
            return floor
        counts, context, types, d = self.levels[level]
        lower = self.p(gram[1:], floor, level + 1)
        if not context[gram[:-1]]:
            return lower
        return (max(counts[gram] - d, 0) + d * types[gram[:-1]] * lower) / context[gram[:-1]]


def plain_grams(text):
    chars = []
    for c in (text or "").lower() + "\n":
        if c.isalpha() or chars and chars[-1] != "\0":
            chars.append(c if c.isalpha() else "\0")
    padded = ["\0"] * (langid.ORDER - 1) + chars
    return ["".join(padded[i:i + langid.ORDER]) for i in range(len(chars))]


def test_the_query_equals_plain_loops(spark, tmp_path):
    """Training counts over all texts of the fold, and every document's language by the lowest entropy."""
    import zlib
    rng = random.Random(8)
    words = {"en": "the cat and dog sat with this that water house", "de": "der hund und die katze mit wasser haus ein zu",
             "fr": "le chat et la maison avec eau une dans pour"}
    rows = []
    for i in range(150):
        lang = rng.choice([*words, None])
        text = " ".join(rng.choices(words[lang or "en"].split(), k=rng.randint(1, 9)))
        rows.append((i, rng.choice([text, text, text.upper(), text + " 12 !", None if i % 9 == 0 else text]), lang, None, 0))
    rows += [(200, "...", "en", None, 3), (201, "", None, None, 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"
                          ).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in LLM_QUERIES["op6_language_id"](spark, str(tmp_path)).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, *_ in rows}
    models = {lang: PlainModel([t for i, t, x, *_ in rows if x == lang and t is not None and not held[i]]) for lang in words}
    floor = 1 / (len(set().union(*(m.chars for m in models.values()))) + 1)
    for i, text, *_ in rows:
        keys = plain_grams(text)
        assert got[i].held_out == held[i]
        if not keys:
            assert got[i].lang_pred == "und" and got[i].score == 0
            continue
        entropy = {x: -sum(math.log(m.p(g, floor)) for g in keys) / len(keys) for x, m in models.items()}
        assert abs(got[i].cross_entropy - min(entropy.values())) < 1e-4
        assert entropy[got[i].lang_pred] <= min(entropy.values()) + 1e-4


def test_ranker_against_plain_loops(spark, monkeypatch):
    """The threshold over all labelled texts, with the labels broadcast or shuffled, and the scores."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["good", "prose", "here.", "well"] if i % 3 else ["#", "!!", "spam", "spam"],
                                     k=rng.randint(1, 60)))) for i in range(240)]
    labels = [(i, int(i % 3 > 0)) for i in range(200)] + [(5, 0), (500, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    known = spark.createDataFrame(labels, "doc_id bigint, quality int")
    model = ranker.train(docs, known, per_class=30)
    monkeypatch.setattr(ranker, "is_bounded", lambda df: False)
    again = ranker.train(docs, known, per_class=30)
    assert again == model
    x = {i: np.array(ranker.features(t)) for i, t in rows}
    strength = {i: float(sum((a - m) / s * w for a, m, s, w in zip(v, model.mean, model.spread, model.weights)))
                for i, v in x.items()}
    taught = [i for i, _ in labels[:200] if i != 5]                # 5 is contradicted; 500 has no text, but counts
    share = sum(i % 3 == 0 for i in taught) / (len(taught) + 1)
    ranked = sorted(strength[i] for i in taught)
    low = ranked[max(math.ceil(share * len(ranked)) - 1, 0)]
    high = min((s for s in ranked if s > low), default=low)
    assert abs(model.threshold - (low + high) / 2) < 1e-9
    got = {r.doc_id: r.score for r in ranker.score(docs, model).collect()}
    for i, s in strength.items():
        assert abs(got[i] - 1 / (1 + math.exp(-max(-50, min(50, (s - model.threshold) / model.scale))))) < 1e-9
