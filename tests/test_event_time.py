"""Event time, two feeds and retraction: nothing lost, state evicted, cost by the trigger's rows."""

import datetime as dt
import random
import uuid

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from quartermaster.operators import metrics as M
from quartermaster.plans import streams
from quartermaster.session import open_files, path_exists, scratch_path
from quartermaster.sources.conform import load_star
from quartermaster.sources.raw import Raw
from quartermaster.streaming import event_time as T
from quartermaster.streaming import upsert as U
from quartermaster.streaming.retract import Refresh

SCHEMA = "order_date date, status string"
DAY = dt.date(2025, 1, 1)


def new(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


def test_days_close_state_is_evicted_and_late_lines_are_kept(spark):
    run, batches = new(spark, "event"), 20
    schema = spark.createDataFrame([], SCHEMA).schema
    feed, late = [], 0
    for i in range(batches):                          # ten days a batch; every third batch brings a line of the first day
        days = [(DAY + dt.timedelta(days=10 * i + j), "delivered") for j in range(10)]
        old = [(DAY, "delayed")] if i and i % 3 == 0 else []
        late += len(old)
        feed.append(days + old)

    def land(i):
        spark.createDataFrame(feed[i], schema).coalesce(1).write.parquet(f"{run}/feed/b={i}")

    _, days = T.replay(spark, list(range(batches)), land, [
        lambda: T.split_late(spark.readStream.schema(schema).parquet(f"{run}/feed/b=*"), "order_date", "5 days",
                             f"{run}/routed", f"{run}/ckpt1"),
        lambda: T.closed_days(T.on_time_stream(spark, schema, f"{run}/routed"), "order_date", "5 days", f"{run}/closed",
                              f"{run}/ckpt2")])
    state = [p["stateOperators"][0] for p in days.recentProgress if p["stateOperators"]]
    assert len({p["batchId"] for p in days.recentProgress}) >= batches
    assert max(s["numRowsTotal"] for s in state) <= 30                 # three batches of days, not all 200
    assert sum(s["numRowsDroppedByWatermark"] for s in state) == 0     # the router left nothing to drop
    got = T.event_counts(spark, schema, "order_date", f"{run}/routed", f"{run}/closed").collect()
    assert sum(r.late_count for r in got) == late
    assert sum(r.order_count + r.late_count for r in got) == sum(map(len, feed))
    assert {r.order_day for r in got if r.is_open} == {DAY + dt.timedelta(days=10 * batches - 1 - j) for j in range(6)}
    closed = spark.read.parquet(f"{run}/closed/epoch=*")
    assert closed.count() == closed.select("order_day", "status").distinct().count()      # each day once


def test_a_replayed_epoch_of_the_router_changes_nothing(spark):
    out = new(spark, "routed")
    first = spark.createDataFrame([(DAY, "a"), (DAY + dt.timedelta(days=9), "a")], SCHEMA)
    second = spark.createDataFrame([(DAY, "late"), (DAY + dt.timedelta(days=8), "on time")], SCHEMA)
    caught = {}

    class Stream:                        # catches the function that split_late hands to foreachBatch
        def __getattr__(self, name):
            return lambda *a, **k: (caught.update(f=a[0]) if name == "foreachBatch" else None) or self

        writeStream = property(lambda self: self)

    T.split_late(Stream(), "order_date", "2 days", out, "unused")
    for epoch, batch in ((0, first), (1, second), (1, second)):
        caught["f"](batch, epoch)
    schema = first.schema
    assert rows(T.routed(spark, schema, out, late=True)) == [(DAY, "late")]
    assert T.routed(spark, schema, out, late=False).count() == 3


def test_lines_on_time_and_late_equal_the_batch_counts(spark):
    orders = load_star(spark, SF_SMALL).purchase_orders.select("order_id", "line_number", "product_id", "order_date", "status")
    got, _ = streams.run_event_time(spark, orders, new(spark, "counts"), months=24)
    want = orders.groupBy("order_date", "status").count()
    both = got.select("order_day", "status", (F.col("order_count") + F.col("late_count")).alias("n"))
    assert rows(both) == rows(want)
    assert got.agg(F.sum("late_count")).first()[0] > 0


def test_a_feed_never_shows_half_a_period(spark):
    feed = f"{new(spark, 'landing')}/lines"
    rows = spark.range(0, 40, 1, 4)

    with pytest.raises(Exception):                 # the other three parts may be written by then
        T.land(spark, rows.where(F.expr("if(id = 39, raise_error('cut') is null, true)")), feed, 7)
    assert not path_exists(spark, f"{feed}/period=7")
    T.land(spark, rows, feed, 7)
    assert spark.read.parquet(f"{feed}/period=*").count() == 40


@pytest.mark.parametrize("backwards", [False, True])
def test_two_feeds_in_any_order_lose_no_line(spark, backwards):
    star = load_star(spark, SF_SMALL)

    lines, joined, late = streams.run_two_streams(
        spark, SF_SMALL, new(spark, "feeds"), order=lambda periods: sorted(periods, reverse=backwards), hours=400)
    assert sorted(map(repr, lines.select(*star.purchase_orders.columns).collect())) == sorted(map(repr, star.purchase_orders.collect()))
    met, alone = (joined.where(c).count() for c in ("o_orderkey is not null", "o_orderkey is null"))
    assert met > 0 and alone > 0
    assert met + alone + late.count() == Raw(spark, SF_SMALL).lineitem.count()


def test_retraction_equals_the_batch(spark):
    star, run = load_star(spark, SF_SMALL), new(spark, "retract")
    highest = M.measure("highest", {"m": ("max", F.col("unit_cost"))}, lambda p: p("m").cast("double"))
    lowest = M.measure("lowest", {"m": ("min", F.col("unit_cost"))}, lambda p: p("m").cast("double"),
                       where=M.NOT_CANCELLED(), where_key="not_cancelled")
    measures = [M.order_count("n"), M.on_time_rate("on_time_pct", scale=1, digits=3), M.total_spend(), highest, lowest]
    got = streams.run_retraction(spark, star, run, measures, triggers=2).kpis()
    from quartermaster.operators.enrich import ORDER_DIMS
    want = M.star_metrics(star, star.purchase_orders, ORDER_DIMS, measures, ["region"], keep_empty=True)
    assert rows(got) == rows(want.select(got.columns))


def refresh_of(spark, folder, buckets=64):
    schema = spark.createDataFrame([], "k long, g string, v decimal(12,2), version int").schema
    total = M.measure("total", {"v": ("sum", F.col("v"))}, lambda p: p("v").cast("double"))
    most = M.measure("most", {"v": ("max", F.col("v"))}, lambda p: p("v").cast("double"))
    return Refresh(spark, folder, schema, ("k",), "version", [M.count_rows(), total, most], ("g",), lambda x: x, buckets)


def versions(spark, r, data):
    return spark.createDataFrame(data, "k long, g string, v double, version int").select(
        "k", "g", F.col("v").cast("decimal(12,2)").alias("v"), "version").to(r.schema)


def test_a_triggers_cost_follows_its_rows_and_replays_are_harmless(spark):
    r = refresh_of(spark, new(spark, "cost"))
    base = [(k, f"g{k % 3}", float(k), 1) for k in range(4000)]
    feeds = [base, [(5, "g0", 1e6, 2), (6, "g0", 7.0, 2)], [(5, "g1", 1.0, 3), (6, "g9", 9.0, 1)], [(3999, "g0", 0.0, 2)]]
    for epoch, data in enumerate(feeds):
        r.apply(versions(spark, r, data), epoch)
        before = rows(r.kpis())
        r.apply(versions(spark, r, data), epoch)                    # a replay
        assert rows(r.kpis()) == before
    state = {}
    for data in feeds:
        for k, g, v, n in data:
            if k not in state or n > state[k][2]:
                state[k] = (g, v, n)
    want = {}
    for g, v, _ in state.values():
        n, total, most = want.get(g, (0, 0.0, float("-inf")))
        want[g] = (n + 1, total + v, max(most, v))
    assert {x.g: (x.n, x.total, x.most) for x in r.kpis().collect()} == want
    first, *small = r.stats
    assert first["changed"] == 4000
    assert all(s["state_rows"] <= 4000 * 3 // 64 + 60 for s in small), r.stats     # two buckets of 64, not the state
    assert path_exists(spark, f"{r.folder}/base/epoch=0") and not path_exists(spark, f"{r.folder}/base/epoch=1")


def test_a_version_is_stored_once_and_only_rows_that_are_asked_for_move(spark, monkeypatch):
    r = refresh_of(spark, new(spark, "moved"), buckets=4)
    r.apply(versions(spark, r, [(k, f"g{k % 3}", float(k), 1) for k in range(4000)]), 0)
    stored = [spark.read.parquet(f"{r.folder}/{k}/epoch=0").count() for k in ("log", "base") if path_exists(spark, f"{r.folder}/{k}/epoch=0")]
    assert stored == [4000]
    dealt, moved = Refresh._dealt, []
    monkeypatch.setattr(Refresh, "_dealt", lambda self, rows, *a: moved.append(rows.count()) or dealt(self, rows, *a))
    r.apply(versions(spark, r, [(k, "g7", 1.0, 2) for k in range(0, 4000, 100)]), 1)
    assert r.stats[-1]["state_rows"] == 4000 and 80 <= moved[0] <= 80 + 4000 // 8        # all buckets are read, few rows move
    assert {x.g: x.n for x in r.kpis().collect()}["g7"] == 40
    assert r.state().count() == 4000


def test_feeds_are_written_without_a_sort_and_the_setting_goes_again(spark):
    name, out = "spark.sql.maxConcurrentOutputFileWriters", new(spark, "open")
    before = spark.conf.get(name, None)
    with open_files(spark, 5):
        spark.range(100).selectExpr("id", "id % 4 as turn").write.partitionBy("turn").parquet(out)
        assert spark.conf.get(name) == "5"
    assert spark.conf.get(name, None) == before
    assert spark.read.parquet(out).count() == 100


def test_ties_of_a_version_are_broken_alike_in_any_order(spark):
    data = [(1, "a", 1.0, 1), (1, "b", 2.0, 1), (1, "c", 3.0, 1)]
    got = set()
    for seed in range(3):
        shuffled = random.Random(seed).sample(data, 3)
        df = spark.createDataFrame(shuffled, "k long, g string, v double, version int").repartition(3)
        got.add(tuple(U.latest_versions(df, ["k"], "version").first()))
    assert len(got) == 1
