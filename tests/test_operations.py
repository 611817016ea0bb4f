"""Ledger, tolerance, ranks, running totals, grouping sets, summaries, versions and sketches."""

import datetime as dt
import random
import uuid
from collections import Counter

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from quartermaster.operators import drift as K
from quartermaster.operators import ledger as L
from quartermaster.operators import metrics as M
from quartermaster.operators import ordered as S
from quartermaster.operators import tolerance as T
from quartermaster.operators.enrich import ORDER_DIMS
from quartermaster.operators.summary import Request, Summary, contained, grains
from quartermaster.plans import results
from quartermaster.session import scratch_path
from quartermaster.sources import catalog as C
from quartermaster.sources.conform import load_star


def new(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


# ---- run ledger ---------------------------------------------------------------
def asked(spark, answers, forbidden=()):
    def build(name, value):
        if name in forbidden:
            raise AssertionError(f"{name} was planned")
        frame = lambda v: spark.createDataFrame([(v,)], "v int")
        return frame(1), frame(value)
    return [L.Asked(name, "c", f"answer {value}", lambda n=name, v=value: build(n, v)) for name, value in answers.items()]


def test_only_failed_and_changed_questions_are_asked_again(spark):
    path = new(spark, "ledger")
    L.record(spark, path, 1, asked(spark, {"a": 1, "b": 2, "c": 1}), "s")
    L.record(spark, path, 2, asked(spark, {"a": 1, "b": 1, "c": 1}, forbidden="ac"), "s")
    L.record(spark, path, 3, asked(spark, {"a": 1, "b": 1, "c": 1}, forbidden="abc"), "s")
    L.record(spark, path, 4, asked(spark, {"a": 1, "b": 1, "c": 1}), "another state")
    got = {(r.run_id, r.question): (r.score, r.carried, r.scored_in) for r in L.history(L.read(spark, path)).collect()}
    assert got[1, "b"] == ("Partial", False, 1) and got[2, "b"] == ("Correct", False, 2)
    assert got[2, "a"] == ("Correct", True, 1) and got[3, "b"] == ("Correct", True, 2)
    assert got[4, "a"] == ("Correct", False, 4) and len(got) == 12


def test_carried_questions_run_no_job_of_their_own(spark):
    path, sc = new(spark, "ledger"), spark.sparkContext

    def jobs(run_id, names):
        sc.setJobGroup(f"{path}-{run_id}", "ledger")
        L.record(spark, path, run_id, asked(spark, {n: 1 for n in names}), "s")
        found = len(sc.statusTracker().getJobIdsForGroup(f"{path}-{run_id}"))
        sc.setLocalProperty("spark.jobGroup.id", None)
        return found

    jobs(1, "abcdef")
    carried = jobs(2, "abcdef")
    assert carried == jobs(3, "abcdef") and carried < jobs(4, "uvwxyz")


# ---- tolerance ----------------------------------------------------------------
def brute(truth, candidate, tolerance):
    """Unmatched counts by side of a largest matching, found by augmenting paths."""
    out = Counter()
    for key in {k for k, _ in truth} | {k for k, _ in candidate}:
        t, c = ([v for k, v in side if k == key] for side in (truth, candidate))
        partner = [None] * len(c)

        def place(i, seen):
            for j, v in enumerate(c):
                if j not in seen and abs(v - t[i]) <= tolerance:
                    seen.add(j)
                    if partner[j] is None or place(partner[j], seen):
                        partner[j] = i
                        return True
            return False

        n = sum(place(i, set()) for i in range(len(t)))
        out["missing", key] += len(t) - n
        out["extra", key] += len(c) - n
    return {k: v for k, v in out.items() if v}


@pytest.mark.parametrize("seed", range(4))
def test_matching_equals_brute_force_with_a_hot_key(spark, seed):
    rng = random.Random(seed)
    side = lambda n: [(rng.choice("aaab"), rng.randrange(60) / 8) for _ in range(n)]
    truth, candidate = side(60), side(70)
    frames = [spark.createDataFrame(x, "k string, v double") for x in (truth, candidate)]
    got = T.diff_within(*frames, "v", 0.25, ranges=5)
    assert {(r.side, r.k): r.n for r in got.groupBy("side", "k").agg(F.sum("n").alias("n")).collect()} == brute(truth, candidate, 0.25)


def test_values_beside_a_rounding_border_are_equal_and_nulls_match_nulls(spark):
    schema = "d decimal(5,2), day date, v double"
    day = dt.date(2025, 1, 1)
    a = spark.createDataFrame([(None, day, 0.4999999), (None, day, None), (None, day, float("nan"))], schema)
    b = spark.createDataFrame([(None, day, 0.5000001), (None, day, None), (None, None, float("nan"))], schema)
    got = sorted((r.side, r.day) for r in T.diff_within(a, b, "v", 1e-6).collect())
    assert got == [("extra", None), ("missing", day)]
    assert T.diff_within(a.limit(0), b.limit(0), "v", 1.0).collect() == []


# ---- ranks, running totals, backlog ---------------------------------------------
def test_dense_rank_with_ties_and_nulls(spark):
    data = [(i, random.Random(i).choice([None, 1.0, 2.0, 2.0, 3.0, 5.0])) for i in range(200)]
    df = spark.createDataFrame(data, "i int, v double")
    order = sorted({v for _, v in data if v is not None}, reverse=True) + [None]
    got = {r.i: r.place for r in S.dense_rank(df, [("v", True)], "place", ranges=4).collect()}
    assert got == {i: order.index(v) + 1 for i, v in data}


def test_running_totals_by_key_over_many_ranges(spark):
    data = [(g, d, random.Random(f"{g}{d}").randrange(9)) for g, n in (("hot", 300), ("x", 5), (None, 7)) for d in range(n)]
    got = S.prefix_sum(spark.createDataFrame(data, "g string, d int, n int"), ["d"], "n", "total", ["g"], ranges=7)
    want = {(g, d): sum(n for h, e, n in data if h == g and e <= d) for g, d, _ in data}
    assert {(r.g, r.d): r.total for r in got.collect()} == want


def test_backlog_at_each_weeks_end_equals_brute_force(spark):
    rng, day = random.Random(3), dt.date(2025, 1, 6)
    opened = [day + dt.timedelta(days=rng.randrange(70)) for _ in range(150)]
    closed = [o + dt.timedelta(days=rng.randrange(30)) if rng.random() < 0.7 else None for o in opened]
    frame = lambda xs: spark.createDataFrame([(x,) for x in xs], "day date")
    got = sorted(S.backlog(frame(opened), frame(closed)).collect())
    for week in range(12):
        end = day + dt.timedelta(days=7 * week + 6)
        known = [r.open for r in got if r.day <= end]
        assert (known[-1] if known else 0) == sum(o <= end and not (c and c <= end) for o, c in zip(opened, closed))


# ---- grouping sets, reduction, summary --------------------------------------------
def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_grouping_sets_scan_the_orders_once(spark):
    star = load_star(spark, SF_SMALL)
    df = results.spend_driver_cube(star)
    plan = executed(df).split("+- == Initial Plan ==")[0]
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line and "purchase_orders" in line]
    assert len(scans) <= 1 + plan.count("ReusedExchange"), plan
    got = {(r.grouped_by, r.region, r.category): r.delta_spend for r in df.collect()}
    total = got["", None, None]
    assert sum(v for (g, *_), v in got.items() if g == "region") == pytest.approx(total)
    assert sum(v for (g, *_), v in got.items() if g == "region,category") == pytest.approx(total, abs=1)


def test_a_selective_filter_reduces_the_fact_before_it_is_aggregated(spark):
    star = load_star(spark, SF_SMALL)
    keys = star.suppliers.select("supplier_id")
    kept = keys.where("supplier_id = 3")
    fact = star.purchase_orders
    want = fact.where("supplier_id = 3").count()
    assert M.reduced(fact, "supplier_id", keys, kept).count() == want
    assert M.reduced(fact, "supplier_id", keys, keys) is fact                   # keeps everything: off
    spark.conf.set("quartermaster.broadcast.maxRows", "0")
    try:
        bits = M.reduced(fact, "supplier_id", keys, kept)
        assert bits.where("supplier_id = 3").count() == want
        assert bits.count() < fact.count() / 2 and bits.columns == fact.columns
        eager = M.star_metrics(star, fact, ORDER_DIMS, [M.total_spend()], ["region"],
                               dim_where={"suppliers": F.col("supplier_id") == 3}, strategy="eager")
        got = rows(eager)
    finally:
        spark.conf.unset("quartermaster.broadcast.maxRows")
    assert got == rows(M.star_metrics(star, fact, ORDER_DIMS, [M.total_spend()], ["region"],
                                      dim_where={"suppliers": F.col("supplier_id") == 3}, strategy="broadcast"))


def test_summary_answers_what_it_contains_and_refreshes_months(spark, golden):
    summary = Summary(golden, new(spark, "summary")).build()
    spend = Request((M.total_spend(),), ("region",))
    assert rows(summary.answer(spend)) == rows(results.kpi_total_spend(golden))
    rate = Request((M.on_time_rate("on_time_pct", scale=1, digits=3),), ("region",))
    assert rows(summary.answer(rate)) == rows(results.kpi_on_time_rate(golden))
    odd = Request((M.avg_days_late(),), ("region",))
    assert not any(contained(odd, g) for g in grains())
    assert summary.answer(odd, lambda: "rows") == "rows"
    with pytest.raises(ValueError, match="no summary"):
        summary.answer(Request((M.total_spend(),), ("lead_time_days",)))
    more = golden.purchase_orders.unionByName(golden.purchase_orders.where("order_id = 'PO-00002'"))
    summary.star = changed = golden.__class__(spark=spark, suppliers=golden.suppliers, products=golden.products,
                                              purchase_orders=more, inventory_snapshots=golden.inventory_snapshots)
    summary.refresh("2024-11", "2024-11")
    assert rows(summary.answer(spend)) == rows(results.kpi_total_spend(changed))
    assert rows(summary.answer(Request((M.total_quantity(),), ("product_name",)))) == rows(
        M.star_metrics(changed, more, ORDER_DIMS, [M.total_quantity()], ["product_name"]))


# ---- versions ---------------------------------------------------------------------
def test_a_killed_write_leaves_the_old_version(spark):
    ns = C.Namespace(schema=f"qm_{uuid.uuid4().hex[:10]}")
    first = C.replace_table(spark.range(5), ns, "t", "five rows", {"id": "a number"})
    assert spark.table(ns.fq("t")).count() == 5
    reader = spark.table(ns.fq("t"))                                            # planned on the first version
    fails = spark.range(100, numPartitions=4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).cast("long").alias("id"), F.lit(1).alias("x"))
    with pytest.raises(Exception, match="killed"):
        C.replace_table(fails, ns, "t")
    assert rows(spark.table(ns.fq("t"))) == [(i,) for i in range(5)]
    assert C.current_version(spark, ns, "t").endswith(first.rsplit("/", 1)[1])
    C.replace_table(spark.range(2).withColumn("y", F.lit("new")), ns, "t", "two rows")
    assert rows(spark.table(ns.fq("t"))) == [(0, "new"), (1, "new")]
    assert reader.count() == 5                                                  # its files are still there
    assert any(first.rsplit("/", 1)[1] in p for p in C.drop_versions(spark, ns, "t"))
    assert rows(spark.table(ns.fq("t"))) == [(0, "new"), (1, "new")]
    comments = {(r.column_name, r.table_comment) for r in C.data_dictionary(spark, ns).collect()}
    assert ("y", "two rows") in comments


# ---- sketches -----------------------------------------------------------------------
def test_sketch_ranks_are_within_the_bound_and_a_shift_is_found(spark):
    rng, n = random.Random(5), 4000
    data = [(dt.date(2025, m, 1), rng.gauss(50 if m < 4 else 60, 10)) for m in range(1, 6) for _ in range(n)]
    df = spark.createDataFrame(data, "day date, v double")
    monthly = K.sketches(df, F.trunc("day", "month"), ["v"])
    got = {r.period.month: r for r in K.drift(monthly).collect()}
    assert [got[m].drifted for m in range(1, 6)] == [False, False, False, True, False]
    values = {m: sorted(v for d, v in data if d.month == m) for m in range(1, 6)}
    rank = lambda xs, x: sum(v <= x for v in xs) / len(xs)
    probes = values[3][::40] + values[4][::40]
    exact = max(abs(rank(values[3], x) - rank(values[4], x)) for x in probes)
    assert abs(got[4].distance - exact) <= 2 * K.RANK_ERROR + 2 / K.PROBES
    for r in monthly.select(F.month("period").alias("m"), K.quantiles(F.col("sketch")).alias("q")).collect():
        assert all(abs(rank(values[r.m], x) - (i + 0.5) / K.PROBES) <= K.RANK_ERROR for i, x in enumerate(r.q))
    year = K.merged(monthly, F.trunc("period", "year")).first()
    assert year.n == 5 * n
