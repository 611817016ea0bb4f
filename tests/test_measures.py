"""Measure layer: guards, rounding, filter folding, eager vs broadcast plans."""

from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from quartermaster.functions import expr as X
from quartermaster.operators import metrics as M
from quartermaster.operators.enrich import ORDER_DIMS
from quartermaster.plans import results as R


def test_ratio_guard_and_half_up(spark):
    df = spark.createDataFrame([(1, 8), (0, 0), (1, 3)], "n long, d long")
    got = [r.v for r in df.select(X.ratio("n", "d", 100, 1).alias("v")).collect()]
    assert got == [12.5, None, 33.3]


def test_avg_exact_half_up_away_from_zero(spark):
    df = spark.createDataFrame([(43, 20), (-43, 20), (5, 2)], "s long, n long")
    got = [r.v for r in df.select(X.avg_exact("s", "n", 1).alias("v")).collect()]
    assert got == [2.2, -2.2, 2.5]


def test_money_is_exact(spark):
    df = spark.createDataFrame([(10, Decimal("149.99"))], "quantity int, unit_cost decimal(12,2)")
    assert df.select(X.money_out(X.order_value()).alias("v")).first().v == 1499.9


def test_shared_filter_is_hoisted_and_groups_dropped(spark):
    df = spark.createDataFrame([("a", "cancelled", 1, Decimal("1.00")), ("b", "delivered", 2, Decimal("3.00"))],
                               "k string, status string, quantity int, unit_cost decimal(12,2)")
    assert rows(M.metrics(df, [M.total_spend()], ["k"])) == [("b", 6.0)]
    assert rows(M.metrics(df, [M.total_spend()], ["k"]).union(
        M.metrics(df, [M.total_spend(), M.order_count()], ["k"]).select("k", "total_spend"))) == \
        [("a", None), ("b", 6.0), ("b", 6.0)]


def test_keep_empty(spark):
    df = spark.createDataFrame([("a", "cancelled", 1, Decimal("1.00"))],
                               "k string, status string, quantity int, unit_cost decimal(12,2)")
    out = M.metrics(df, [M.total_spend(), M.delayed_count()], ["k"])
    assert out.count() == 0
    assert M.metrics(df, [M.total_spend(), M.delayed_count()], ["k"], keep_empty=True).count() == 1


def test_eager_equals_broadcast(golden):
    ms = [M.order_count(), M.on_time_rate(), M.total_spend(), M.avg_variance_days()]
    by = ["region", "category", "status"]
    a = M.star_metrics(golden, golden.purchase_orders, ORDER_DIMS, ms, by, strategy="broadcast")
    b = M.star_metrics(golden, golden.purchase_orders, ORDER_DIMS, ms, by, strategy="eager")
    assert rows(a) == rows(b.select(*a.columns))


def test_rollup_parts_ratio(golden):
    parts = M.star_metrics(golden, golden.purchase_orders, ORDER_DIMS, [M.on_time_rate("r", 1, 3)],
                           ["region"], parts_only=True, strategy="eager")
    got = {r.region: r.r for r in M.rollup_parts(parts).collect()}
    assert got[None] == 0.667 and got["Europe"] == 1.0


def test_in_month_is_half_open(spark):
    df = spark.createDataFrame([("2025-01-31",), ("2025-02-01",)], "d string").select(F.to_date("d").alias("d"))
    assert df.where(X.in_month("d", "2025-01")).count() == 1


def test_mom_change_uses_calendar_months(golden):
    got = {r.order_month.month: (r.prev_monthly_spend, r.mom_change, r.mom_pct)
           for r in R.x_spend_mom_change(golden).collect()}
    assert got[10] == (None, None, None)
    assert got[11] == (100.0, 359.95, 360.0)
    assert got[12] == (459.95, 0.05, 0.0)


def test_latest_only_global_and_per_key(spark):
    from quartermaster.operators.joins import latest_only
    import datetime as dt
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 1, 8)
    df = spark.createDataFrame([("a", d1, 1), ("a", d2, 2), ("b", d1, 3)], "k string, d date, v int")
    assert rows(latest_only(df, "d"), "k", "v") == [("a", 2)]          # global latest (T17)
    assert rows(latest_only(df, "d", per=["k"]), "k", "v") == [("a", 2), ("b", 3)]


def test_global_aggregate_keeps_its_row(spark):
    df = spark.createDataFrame([("a", "cancelled", 1, Decimal("1.00"))],
                               "k string, status string, quantity int, unit_cost decimal(12,2)")
    got = M.metrics(df, [M.total_spend(), M.delayed_count()]).collect()
    assert len(got) == 1 and got[0].total_spend is None and got[0].delayed_orders == 0


def test_broadcast_check_counts_bytes(spark):
    from quartermaster.operators.joins import is_bounded, max_broadcast_rows
    df = spark.range(100).selectExpr("id", "repeat('x', 10) AS s")
    s2 = spark.newSession()
    s2.conf.set("quartermaster.broadcast.maxBytes", "1000")
    narrow = s2.range(100).selectExpr("id", "repeat('x', 10) AS s")
    assert max_broadcast_rows(df) > 100 and is_bounded(df)
    assert max_broadcast_rows(narrow) < 100 and not is_bounded(narrow)


def test_measure_synonyms():
    assert M.measure_for("OTD rate").name == "on_time_delivery_rate"
    assert M.measure_for("Total Cost").name == "total_spend"
    assert M.measure_for("at-risk items").name == "low_stock_count"
    import pytest
    with pytest.raises(KeyError):
        M.measure_for("happiness")


def test_namespace_from_conf(spark):
    from quartermaster.sources.catalog import Namespace
    s2 = spark.newSession()
    s2.conf.set("quartermaster.schema", "lab")
    assert Namespace.from_conf(s2).fq("t") == "`spark_catalog`.`lab`.`t`"
    assert Namespace.from_conf(spark).schema == "supply_chain"
