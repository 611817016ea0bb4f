"""SimHash: fingerprints by hand, links and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from quartermaster.llm import simhash


def by_hand(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).replace("\t", " ")
             .replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n ", "a", "A b", "x y z w", "É b  c\td e f g É b c d"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == by_hand(text)


def roots(fps, max_bits=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    pairs = set()
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= max_bits:
                pairs.add((i, j))
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))], pairs


def cloud(seed, groups=12, members=25):
    rng = random.Random(seed)
    out = {0}
    for _ in range(groups):
        base = rng.getrandbits(64)
        for _ in range(members):
            x = base
            for b in rng.sample(range(64), rng.randint(0, 6)):
                x ^= 1 << b
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("hot_bucket", [4096, 3])
def test_links_and_components_equal_brute_force(spark, hot_bucket):
    fps = cloud(hot_bucket)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    want, pairs = roots(fps)
    edges = simhash.links(spark, nodes, hot_bucket=hot_bucket)
    got = [(r.fp, r.other) for r in edges.collect()]
    assert len(got) == len(set(got))                                   # each link once
    assert set(got) == {tuple(sorted((signed[i], signed[j]))) for i, j in pairs}
    root = {r.node: r.root for r in simhash.components(spark, edges).collect()}
    groups = lambda of: {frozenset(x for x in range(len(fps)) if of(x) == of(y)) for y in range(len(fps))}
    assert groups(lambda x: want[x]) == groups(lambda x: root.get(signed[x], signed[x]))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.root for r in simhash.components(spark, edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 400: 400, 500: 400}


def test_thresholds_find_every_link():
    """The allocated radii sum to max_bits - m + 1, which the pigeonhole needs, at any corpus size."""
    sample = np.array(cloud(1), np.uint64)
    for n in (100, 10**5, 10**7, 10**9):
        for m in range(3, 6):
            groups = simhash.partitions(sample, m)
            assert sorted(b for g in groups for b in g) == list(range(64))
            cost, t = simhash.allocate(sample, groups, 4, n)
            assert sum(t) == 4 - m + 1 and cost > 0
    few, many = simhash.plan(sample, 4, 10**4), simhash.plan(sample, 4, 10**9)
    width = lambda cut: min(len(b) for b, _ in cut)
    assert width(many) > width(few)                                    # longer keys for more documents


def test_documents(spark):
    rng = random.Random(5)
    words = ["w%d" % i for i in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 300))) for _ in range(60)]
    texts += [t.upper() for t in texts[:20]] + [t + " more" for t in texts[:30]] + ["", "  ", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want, _ = roots([by_hand(t or "") for t in texts])
    assert {r.doc_id: r.component for r in simhash.dedup(spark, df).collect()} == dict(enumerate(want))
