"""Streaming: every order line is counted in any number of batches; replays are harmless."""

import datetime as dt
import uuid

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from quartermaster.plans import results
from quartermaster.session import scratch_path
from quartermaster.sources.conform import load_star
from quartermaster.sources.raw import Raw
from quartermaster.streaming import refresh as R
from quartermaster.streaming import upsert as U

SCHEMA = "order_date date, status string"


def new(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


def batches(spark, checkpoint):
    """Committed micro-batches of a run."""
    return spark.read.format("binaryFile").load(f"{checkpoint}/commits/*").select("path").where(
        ~F.col("path").contains(".crc")).count()


def test_lines_of_old_days_are_counted_whenever_they_come(spark):
    src, out = new(spark, "src"), new(spark, "out")
    d = dt.date(2025, 1, 1)
    first = [(d + dt.timedelta(days=i), "delivered") for i in range(20)]
    late = [(d, "delivered"), (d + dt.timedelta(days=40), "delivered")]
    for name, rows in (("b1", first), ("b2", late)):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{src}/{name}")
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{src}/b*")
        R.run_daily_counts(stream, f"{out}/daily", f"{out}/ckpt").awaitTermination()
    got = {r.order_day: (r.order_count, r.is_open) for r in R.mark_open(spark.read.parquet(f"{out}/daily")).collect()}
    assert got[d] == (2, False) and got[d + dt.timedelta(days=19)] == (1, False)
    assert got[d + dt.timedelta(days=40)] == (1, True) and len(got) == 21


@pytest.mark.parametrize("n", [1, 5])
def test_one_and_many_batches_count_every_order_line(spark, n):
    run = new(spark, "daily")
    R.run_daily_counts(R.order_stream(spark, SF_SMALL, run, batches=n), f"{run}/out", f"{run}/ckpt").awaitTermination()
    assert batches(spark, f"{run}/ckpt") >= n
    daily = spark.read.parquet(f"{run}/out")
    assert daily.agg(F.sum("order_count")).first()[0] == Raw(spark, SF_SMALL).lineitem.count()
    month = {tuple(r) for r in results.monthly_orders_by_status(load_star(spark, SF_SMALL)).collect()}
    assert {(r.order_month, r.status, r.order_count) for r in R.rollup_daily_to_month(daily).collect()} == month


def test_kpis_and_alerts_over_several_batches(spark):
    run, star = new(spark, "kpi"), load_star(spark, SF_SMALL)
    rules = spark.createDataFrame([("on_time_pct", "<", 2.0)], "measure string, op string, threshold double")
    R.refresh_stream(R.order_stream(spark, SF_SMALL, run), star.suppliers, f"{run}/out", f"{run}/ckpt",
                     on_batch=R.alert_sink(rules, f"{run}/alerts")).awaitTermination()
    assert batches(spark, f"{run}/ckpt") >= 3
    batch = {r.region: r.total_spend for r in results.kpi_total_spend(star).collect()}
    assert {r.region: r.total_spend for r in spark.read.parquet(f"{run}/out").collect()} == batch
    alerts = R.read_alerts(spark, f"{run}/alerts")
    assert alerts.select("epoch").distinct().count() >= 3
    last = R.read_alerts(spark, f"{run}/alerts", latest=True)
    assert last.count() == len(batch) and last.agg(F.min("epoch") == F.max("epoch")).first()[0]


def test_alert_replay_changes_nothing_and_no_alert_is_an_empty_frame(spark):
    sink = new(spark, "alerts")
    kpi = spark.createDataFrame([("a", 0.2), ("b", 0.9)], "region string, on_time_pct double")
    low = spark.createDataFrame([("on_time_pct", "<", 0.3)], "measure string, op string, threshold double")
    none = spark.createDataFrame([("on_time_pct", "<", 0.1)], "measure string, op string, threshold double")
    for _ in range(2):
        R.alert_sink(low, sink)(kpi, 0)
    assert [(r.region, r.epoch) for r in R.read_alerts(spark, sink).collect()] == [("a", 0)]
    R.alert_sink(none, sink)(kpi, 1)
    assert R.read_alerts(spark, sink).count() == 1
    assert R.read_alerts(spark, sink, latest=True).collect() == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        R.read_alerts(spark, sink + "-missing").count()


def test_newest_version_in_any_order_and_over_replays(spark):
    log, schema = new(spark, "log"), "k long, status string, version int"
    newer, older = [(1, "delivered", 2), (2, "in_transit", 1)], [(1, "in_transit", 1), (1, "in_transit", 1)]
    for epoch, rows in ((0, newer), (1, older), (0, newer)):                # out of order, and a replay
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{log}/epoch={epoch}")
    got = U.current_state(spark, log, schema, ["k"]).collect()
    assert sorted((r.k, r.status, r.version) for r in got) == [(1, "delivered", 2), (2, "in_transit", 1)]


def test_a_corrected_price_is_no_second_line(spark):
    orders = load_star(spark, SF_SMALL).purchase_orders
    keyed = U.with_occurrence(orders)
    assert keyed.select(*U.ORDER_KEYS).distinct().count() == orders.count()
    v1, v2 = U.order_versions(keyed)
    changed = v1.where("unit_cost <> 0").join(v2.select(*U.ORDER_KEYS, F.col("unit_cost").alias("final")), list(U.ORDER_KEYS))
    assert changed.where("unit_cost = final").count() == 0 and changed.count() > 0
    state = U.latest_versions(v1.unionByName(v2), U.ORDER_KEYS, "version").select(orders.columns)
    assert sorted(map(repr, state.collect())) == sorted(map(repr, orders.collect()))
