"""The stored star follows its inputs, writes what is asked for, and opens what is needed."""

import uuid

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from quartermaster.functions import sqlfuncs
from quartermaster.operators import joins
from quartermaster.plans import results as R
from quartermaster.plans.trusted import answer
from quartermaster.session import path_exists, scratch_path
from quartermaster.sources.conform import dense_suppliers, load_star

TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture()
def folder(spark):
    """A copy of the raw tables that a test may change."""
    path = scratch_path(spark, f"raw-{uuid.uuid4().hex[:8]}")
    for t in TABLES:
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{path}/{t}.parquet")
    return path


def test_a_changed_file_gives_a_new_answer(spark, folder):
    before = R.q_order_count(load_star(spark, folder)).first()[0]
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(100).write.mode("overwrite").parquet(
        f"{folder}/lineitem.parquet")
    assert R.q_order_count(load_star(spark, folder)).first()[0] == 100 < before


def test_a_supplier_question_writes_no_fact(spark, folder):
    star = load_star(spark, folder)
    assert R.bm_suppliers_in_region(star).first().supplier_count >= 0
    assert path_exists(spark, f"{star.path}/suppliers/_SUCCESS")
    assert not any(path_exists(spark, f"{star.path}/{t}") for t in ("products", "purchase_orders", "inventory_snapshots"))


def test_sparse_supplier_keys_fail_loudly(spark, folder):
    s = spark.read.parquet(f"{SF_SMALL}/supplier.parquet")
    s.withColumn("s_suppkey", F.col("s_suppkey") + 1).write.mode("overwrite").parquet(f"{folder}/supplier.parquet")
    with pytest.raises(ValueError, match="supplier keys"):
        dense_suppliers(spark, folder)
    with pytest.raises(ValueError, match="supplier keys"):
        load_star(spark, folder)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_month_windows_open_only_their_folders(spark):
    star = load_star(spark, SF_SMALL)
    for df in (R.q_spend_drivers(star), R.x_spend_volume_price(star), R.q_order_value_by_eta_month(star)):
        plan = executed(df)
        assert "stored_month" in plan and "PartitionFilters: [isnotnull(stored_month" in plan
    months = star.orders_of("2000-10", "2000-12")
    assert len({f.split("stored_month=")[1][:7] for f in months.inputFiles()}) >= 3


def test_latest_snapshot_is_found_without_a_join(spark):
    star = load_star(spark, SF_SMALL)
    optimized = R.q_below_reorder_now(star)._jdf.queryExecution().optimizedPlan().toString()
    subquery = optimized[optimized.index("scalar-subquery"):]
    assert "max(snapshot_date" in subquery
    assert "Join" not in subquery.split("max(snapshot_date")[1]
    sqlfuncs.register(spark, star)
    plan = executed(sqlfuncs.low_stock_as_of(spark, __import__("datetime").date(2001, 1, 1)))
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_small_files_are_merged(spark):
    star = load_star(spark, SF_SMALL)
    snapshots = star.inventory_snapshots.select("snapshot_date").distinct().count()
    assert len(star.inventory_snapshots.inputFiles()) <= 2 * snapshots


def test_broadcast_check_measures_strings(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 10_000).alias("s"))
    assert joins.is_bounded(df)
    spark.conf.set("quartermaster.broadcast.maxBytes", "500000")
    try:
        assert joins.is_bounded(df.select("id")) and not joins.is_bounded(df)
    finally:
        spark.conf.unset("quartermaster.broadcast.maxBytes")


def test_inventory_dims_are_checked_as_sent(spark, golden):
    from quartermaster.operators.enrich import product_supplier_dim
    wide = product_supplier_dim(golden)
    spark.conf.set("quartermaster.broadcast.maxBytes", str(3 * joins.row_width(golden.products) + 130))
    try:
        golden._bounded.clear()
        assert not golden.small_frame("products", wide)
    finally:
        spark.conf.unset("quartermaster.broadcast.maxBytes")
        golden._bounded.clear()


def test_questions_take_their_own_values(spark):
    ask = "How many suppliers are in Asia-Pacific?"
    assert answer(spark, SF_SMALL, ask).first().supplier_count == 0               # no such region in these tables
    assert answer(spark, SF_SMALL, ask, region="ASIA").first().supplier_count == \
        R.bm_suppliers_in_region(load_star(spark, SF_SMALL)).first().supplier_count
    eta = "What is the total order value for orders with an ETA in January 2025?"
    assert answer(spark, SF_SMALL, eta).first().order_value is None
    assert answer(spark, SF_SMALL, eta, month="2001-01").first().order_value > 0
    with pytest.raises(ValueError):
        answer(spark, SF_SMALL, "What is the average order value?", region="ASIA")
