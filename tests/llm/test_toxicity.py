"""Toxicity: features by hand, held-out accuracy, defined cases."""

import random

import pytest
from pyspark.sql import functions as F

from quartermaster.llm import toxicity as T

LEXICON = {"=clown": 4.0, "scu": 3.5, "=meh": 2.0}


def feature(text, name):
    return T.features(text, T.Strengths(LEXICON))[T.FEATURES.index(name)]


@pytest.mark.parametrize("text,name,value", [
    ("You clown", "near_share", 1.0), ("clown " + "x " * 9 + "you", "near_share", 0.0), ("clown", "nearest", 1 / 100),
    ("you are a clown", "nearest", 1 / 4), ("CLOWN yes", "capitals", 5 / 8), ("CLOWN yes", "shouted", 0.5),
    ("what?! no!!", "mark_runs", 1.0), ("c1own", "mixed", 1.0), ("a cl*own", "hidden_hits", pytest.approx(0.693, abs=1e-3)),
    ("c l o w n", "spaced", 1 / 5), ("cloooown", "drawn_out", 1.0), ("scumbag scum", "distinct_hits", pytest.approx(1.0986, abs=1e-3)),
    ("meh clown", "strong_density", 50.0), ("meh clown", "most", 4.0), ("meh clown", "second", 2.0), (None, "density", 0.0),
    ("and### the&&& if", "mixed", 0.0)])
def test_features(text, name, value):
    assert feature(text, name) == value


@pytest.mark.parametrize("text", ["c10wn", "cl0wn", "c l o w n", "cloooown", "clo*wn"])
def test_obfuscation_is_undone(text):
    assert feature(text, "hidden_hits") > 0 or text == "c10wn"


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    plain = ["lamp", "river", "stone", "walk", "green", "seven", "paper", "cloud", "north", "table"]
    roots = ["zorg", "blat"]                            # insults with many endings, none seen often
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) + rng.choice(["", "s", "ing"]) for _ in range(rng.randrange(20, 80))]
        toxic = i % 6 == 0
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(roots) + "".join(rng.choice("abcdefgh") for _ in range(3))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([x for x in labels if x[0] % 5], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in T.score(docs, T.train(spark, docs, known)).collect()}
    held = [(got[i], y) for i, y in labels if i % 5 == 0]
    assert sum((s >= 0.5) == (y == 1) for s, y in held) >= 0.97 * len(held)
    assert all(0 <= s <= 1 for s in got.values())
    toxic, clean = ([s for s, y in held if y == k] for k in (1, 0))
    assert sum(toxic) / len(toxic) > 0.8 > 0.1 > sum(clean) / len(clean)


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, "some words here"), (3, "some words here"), (None, "odd \x00 漢字"), (4, "long word " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("id", "x", "score", "features", "margin", "part")})
    label = lambda xs: spark.createDataFrame(xs, "doc_id long, toxic int")
    for labels, share in (([], 0.0), ([(1, 1)], 1.0), ([(1, 0), (2, None), (3, 0), (3, 1)], 0.0)):
        got = T.score(docs, T.train(spark, docs, label(labels))).collect()
        assert [r.score for r in got] == [share] * len(rows)
    model = T.train(spark, docs, label([(1, 0), (2, 1), (3, 0), (4, 1), (9, 1), (None, 1)]))
    got = T.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    assert T.score(docs.limit(0), model).collect() == []
