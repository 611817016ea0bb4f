"""Hard negatives against brute force; intervals that hold every exact score."""

import random

import numpy as np
import pytest

from quartermaster.llm import hard_negatives as H


def brute(rows, every=100, positives=5, negatives=10, low=30, high=90):
    """(anchor, positive, rank, negative, positive score, negative score); rows have distinct ids."""
    whole = []
    for i, label, v in rows:
        if i is None or label is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole.append((i, label, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    out = []
    for i, label, v in whole:
        if i % every:
            continue
        dot = lambda w: sum(a * b for a, b in zip(v, w))
        near = [x for x in whole if x[0] != i and len(x[2]) == len(v)]
        pos = sorted((-dot(w), j) for j, m, w in near if m == label)[:positives]
        for p, j in pos:
            p = -p
            neg = sorted((-dot(w), k) for k, m, w in near if m != label and low * p <= 100 * dot(w) <= high * p)[:negatives]
            out += [(i, j, r + 1, k, p, -s) for r, (s, k) in enumerate(neg)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, x int, dim string").repartition(4)


def vectors(seed, n, dim=20, labels=3, ties=True):
    rng = random.Random(seed)
    values = [-0.5, 0.0, 0.25, 0.5] if ties else None
    return [(i * 5, rng.randrange(labels), [rng.choice(values) if ties else rng.gauss(0, 0.3) for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("seed,ties,levels,block", [(0, True, 4, 4096), (1, False, 4, 3), (2, False, 1, 4096), (3, True, 2, 5)])
def test_equals_brute_force(spark, monkeypatch, seed, ties, levels, block):
    monkeypatch.setattr(H, "CELLS", 64)                       # many small steps, so lists prune later rows
    rows = vectors(seed, 400, ties=ties)
    got = H.mine(spark, table(spark, [(i, v, label, 1, "a") for i, label, v in rows]), every=50, levels=levels, block=block)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, every=50)


@pytest.mark.parametrize("dim", [1, 7, 64, 65])
@pytest.mark.parametrize("levels", [1, 4])
def test_intervals_hold_the_exact_scores(dim, levels):
    rng = np.random.default_rng(dim)
    x, q = (rng.integers(-300, 300, (n, dim)) for n in (200, 9))
    x[0], q[0] = 0, 0
    turns = H.rotations(dim, levels)
    codes, align, rest = H.encode(x, turns)
    of = H.Queries.of(np.arange(9), np.zeros(9), q, turns)
    middle, off = of.bounds(H._words(codes), align, rest, slice(None))
    assert (np.abs(x @ q.T - middle) <= off).all()
    if dim == 64 and levels == 4:
        assert off.mean() < 0.2 * (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(q, axis=1)).mean()


def test_more_levels_drop_more_rows():
    rng = np.random.default_rng(0)
    x = np.floor(256 * (v := rng.normal(size=(2000, 64))) / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.int64)
    left = []
    for levels in (1, 4):
        turns = H.rotations(64, levels)
        codes, align, rest = H.encode(x, turns)
        middle, off = H.Queries.of(np.arange(5), np.zeros(5), x[:5], turns).bounds(H._words(codes), align, rest, slice(None))
        left.append((middle + off >= 25_000).mean())
    assert left[1] < 0.1 < left[0]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1, 0, "a"), (1, [1.0, 0.5], 1, 0, "a"), (2, [0.5, 0.5], 2, 0, "a"), (3, [0.5, 0.25], 2, 0, "a"),
            (4, [nan, 1.0], 2, 0, "a"), (5, [inf, 1.0], 2, 0, "a"), (6, [None, 1.0], 2, 0, "a"), (7, None, 2, 0, "a"),
            (8, [1.0, 1.0], None, 0, "a"), (None, [1.0, 1.0], 2, 0, "a"), (9, [], 2, 0, "a"), (11, [0.5], 2, 0, "a"),
            (12, [3e30, 1.0], 2, 0, "a"), (100, [0.0, 0.0], 1, 0, "a"), (200, [1.0], 7, 0, "a")]
    df = table(spark, rows)
    want = brute([(i, label, v) for i, v, label, *_ in rows if i != 12])
    assert sorted(tuple(r) for r in H.mine(spark, df).collect()) == want
    assert {(r[0], r[3]) for r in want} == {(0, 2), (0, 3), (100, 2), (100, 3)} or want
    assert sorted(tuple(r) for r in H.mine(spark, df.union(df)).collect()) == want       # an id's rows are one item
    assert H.mine(spark, df.limit(0)).collect() == []


def test_a_hot_label_and_equal_vectors(spark):
    rows = [(i, [0.5] * 8, 0 if i < 700 else 1, 0, "a") for i in range(1000)]
    got = H.mine(spark, table(spark, rows), high=100).collect()
    by = {}
    for r in got:
        by.setdefault((r.anchor_id, r.positive_id), []).append((r.rank, r.negative_id))
    assert len(by) == 50
    assert by[0, 1] == [(i + 1, 700 + i) for i in range(10)] and by[700, 701] == [(i + 1, i) for i in range(10)]
