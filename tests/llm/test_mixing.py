"""Mixing: targets by hand, the fold against a plain loop, sums, odds and reruns."""

from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from quartermaster.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    """Fill all open sources by weight, close those above their cap, and start again."""
    names = sorted((n for n in sizes if n is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, done = float(sum(sizes.values())), {}
    while True:
        open_ = [n for n in names if n not in done]
        left = total - sum(done.values())
        share = {n: left * weight[n] / sum(weight[m] for m in open_) for n in open_}
        over = [n for n in open_ if share[n] >= cap * sizes[n]]
        if not over:
            return {**done, **share}
        done.update({n: float(cap * sizes[n]) for n in over})


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, None: 20}, {"z": 10}, {"a": 0, "b": 7},
    {"é": 5, "z": 400, "Z": 3, "aa": 2, "a": 1, None: 1000}, {"a": 0}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in got)


def documents(spark, n=900):
    rows = [(i, " ".join(["w"] * (1 + i * 37 % 90)), "s%d" % (0 if i % 3 else i % 7)) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None, "s1"), (n + 1, "", None), (n + 2, "a b", None)],
                                 "doc_id bigint, text string, source string")


@pytest.mark.parametrize("block", [256, 8])
def test_words_near_target(spark, block):
    df = documents(spark)
    a = mixing.mix(spark, df, block=block).collect()
    b = mixing.mix(spark, df.repartition(7), block=block).collect()
    assert sorted(a, key=str) == sorted(b, key=str)                    # reruns agree, however the rows lie
    assert len(a) == df.count() and all(0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in a)
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in a:
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s]
    assert abs(sum(target.values()) - sum(r.size for r in a)) < 1e-6


def test_odds(spark):
    """Over many seeds, a document is taken about as often as its probability says."""
    rows = [("s", i, 10.0 + i % 5, 0.3, 40) for i in range(40)]
    docs = spark.createDataFrame(rows, "source string, id bigint, size double, expected double, n bigint")
    counts, seeds = defaultdict(int), range(12)
    for seed in seeds:
        for r in mixing.round_copies(spark, docs, block=16, seed=seed).collect():
            counts[r.id] += r.copies
    mean = sum(counts.values()) / (len(rows) * len(seeds))
    assert abs(mean - 0.3) < 0.03 and max(counts.values()) < len(seeds)


def spark_hash(values, seed=42):
    for v, bits in values:
        seed = xxhash.xxh64_intdigest(int(v).to_bytes(bits // 8, "little", signed=True), seed)
    return seed


def plain_fold(docs, level, seed):
    """docs: (id, size, mass) in order; returns {id: 0 or 1} of the decided and the residual."""
    done, carry = {}, list(docs[0])
    for i, (y, cap_b, b) in enumerate(docs[1:]):
        x, cap_a, a = carry
        to_a, to_b = min(cap_a - a, b), min(a, cap_b - b)
        h = spark_hash([(x, 64), (y, 64), (i, 32), (level, 32), (seed, 32)])
        if (h >> 11) / 2.0**53 * (to_a + to_b) < to_b:
            if cap_a - a <= b:
                done[x], carry = 1, [y, cap_b, b - (cap_a - a)]
            else:
                done[y], carry = 0, [x, cap_a, a + b]
        elif a <= cap_b - b:
            done[x], carry = 0, [y, cap_b, a + b]
        else:
            done[y], carry = 1, [x, cap_a, a - (cap_b - b)]
    return done, carry


def test_fold_equals_a_plain_loop(spark):
    docs = [(i, float(50 - i), (50 - i) * 0.37) for i in range(40)]
    df = spark.createDataFrame([([(i, s, m, 0) for i, s, m in docs],)],
                               "d array<struct<id:bigint,size:double,mass:double,whole:bigint>>")
    got = df.select(mixing._fold(F.col("d"), "bigint", 2, 42).alias("f")).first().f
    done, carry = plain_fold(docs, 2, 42)
    assert {x.id: x.extra for x in got.done} == done
    assert [got.id, got.size] == carry[:2] and abs(got.mass - carry[2]) < 1e-9


def test_repeated_rows_are_dealt_into_blocks(spark):
    """100,000 rows of one null id: each has a number of its own, and the sums are those of different documents."""
    df = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b c").alias("text"),
                                     F.lit("s").alias("source"))
    df = df.unionByName(spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"),
                                                 F.lit("t").alias("source")))
    rows = mixing._numbered(df.select("source", F.col("doc_id").alias("id")))
    assert rows.distinct().count() == df.count()
    got = mixing.mix(spark, df).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("taken").alias("taken"), F.max("target").alias("target"),
        F.max(F.col("taken") / F.col("size")).alias("most")).collect()
    assert sorted(r.n for r in got) == [1000, 100_000]
    assert all(abs(r.taken - r.target) <= 3 and r.most <= 3 for r in got)
