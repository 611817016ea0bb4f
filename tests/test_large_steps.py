"""Steps that have to stay within a task's memory and move few rows, on large tables too."""

import uuid

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from quartermaster.operators import metrics as M
from quartermaster.operators import quality as Q
from quartermaster.session import scratch_path
from quartermaster.sources import conform as C
from quartermaster.sources.raw import Raw
from quartermaster.streaming import refresh as R
from quartermaster.streaming import retract as T
from quartermaster.streaming import upsert as U


def new(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    return a.exceptAll(b.select(a.columns)).count() == 0 and b.select(a.columns).exceptAll(a).count() == 0


def test_daily_counts_leave_the_state_in_its_partitions(spark, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "coalesce", lambda *a: pytest.fail("all state in one task"))
    src, out = new(spark, "src"), new(spark, "out")
    spark.createDataFrame([("a",), ("b",), ("a",)], "status string").withColumn(
        "order_date", F.lit("2025-01-01").cast("date")).select("order_date", "status").write.parquet(f"{src}/b1")
    stream = spark.readStream.schema("order_date date, status string").parquet(f"{src}/b*")
    R.run_daily_counts(stream, f"{out}/daily", f"{out}/ckpt").awaitTermination()
    got = spark.read.parquet(f"{out}/daily")
    assert sorted((r.status, r.order_count) for r in got.collect()) == [("a", 2), ("b", 1)]
    assert len(got.inputFiles()) == 1


def test_a_landed_feed_has_files_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(R, "FEED_ROWS", 300, raising=False)
    run = new(spark, "feed")
    R.order_stream(spark, SF_SMALL, run)
    feed, lines = spark.read.parquet(f"{run}/feed"), Raw(spark, SF_SMALL).lineitem
    assert same(feed, lines)
    sizes = [r["count"] for r in feed.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 300 * 1.1 and len(sizes) % R.BATCHES == 0


def test_order_lines_are_joined_unsorted_and_moved_narrow(spark):
    star = C.lazy_star(spark, SF_SMALL)
    text = plan(star.purchase_orders)
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text
    laid = star.laid(lambda df: df.withColumn(C.ORDER_MONTH, F.date_format("order_date", "yyyy-MM")).hint(
        "rebalance", F.col(C.ORDER_MONTH)))
    below = plan(laid).split("REBALANCE")[1]
    assert "expected_delivery_date" not in below
    assert same(laid.drop(C.ORDER_MONTH), star.purchase_orders)


def test_a_stored_inventory_comes_in_partitions_of_one_date(spark, monkeypatch):
    monkeypatch.setattr(C, "PANEL_PRODUCTS", 60, raising=False)
    star = C.lazy_star(spark, SF_SMALL)
    panel = star.panel()
    each = panel.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count_distinct("snapshot_date").alias("dates"), F.count(F.lit(1)).alias("n")).collect()
    assert {r.dates for r in each} == {1} and max(r.n for r in each) < 2 * 60 * len(C.WAREHOUSES)
    assert same(panel, star.inventory_snapshots)
    stored = C.materialize_star(star, new(spark, "star"))
    assert same(stored.inventory_snapshots, star.inventory_snapshots)
    assert same(stored.purchase_orders, star.purchase_orders)


def test_keys_are_dealt_out_before_they_are_counted(spark, monkeypatch):
    monkeypatch.setattr(Q, "KEY_ROWS", 100, raising=False)
    star = C.lazy_star(spark, SF_SMALL)
    report = Q.uniqueness_report(star)
    assert plan(report).count("REPARTITION_BY_NUM") >= 4
    assert {r.table_name for r in report.collect()} == {"suppliers", "products", "inventory_snapshots", "purchase_orders"}


def test_the_first_trigger_seeks_the_newest_versions_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(T, "latest_versions", lambda *a: calls.append(1) or U.latest_versions(*a))
    schema = spark.createDataFrame([], "k long, g string, v decimal(12,2), version int").schema
    total = M.measure("total", {"v": ("sum", F.col("v"))}, lambda p: p("v").cast("double"))
    r = T.Refresh(spark, new(spark, "first"), schema, ("k",), "version", [M.count_rows(), total], ("g",), lambda x: x, 4)
    of = lambda rows: spark.createDataFrame(rows, "k long, g string, v double, version int").select(
        "k", "g", F.col("v").cast("decimal(12,2)").alias("v"), "version").to(schema)
    r.apply(of([(1, "a", 5.0, 1), (1, "a", 7.0, 2), (2, "b", 1.0, 1), (None, "b", 3.0, 1)]), 0)
    assert not calls
    assert r.state().count() == 3
    r.apply(of([(2, "a", 2.0, 2), (2, "a", 9.0, 1), (3, "b", 4.0, 1)]), 1)
    assert sorted(map(tuple, r.kpis().collect()), key=repr) == [("a", 2, 9.0), ("b", 2, 7.0)]
