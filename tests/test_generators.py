"""Seeded generators: reference sizes, partition independence, planted facts."""

import datetime as dt

from pyspark.sql import functions as F

from quartermaster.sources import generate as G


def test_reference_sizes(spark):
    t = G.build_all(spark)
    assert {k: v.count() for k, v in t.items()} == {
        "suppliers": 15, "products": 30, "purchase_orders": 800, "inventory_snapshots": 2040}


def test_partitioning_does_not_change_rows(spark):
    s = G.gen_suppliers(spark)
    p = G.gen_products(spark, s)
    a = G.gen_purchase_orders(spark, p, s, n=2000)
    b = G.gen_purchase_orders(spark, p.repartition(7), s.repartition(3), n=2000)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_order_facts(spark):
    t = G.build_all(spark, scale=20)
    po = t["purchase_orders"]
    bad = po.where((F.col("status") == "delivered") != F.col("actual_delivery_date").isNotNull()).count()
    assert bad == 0
    mix = {r.status: r["count"] / po.count() for r in po.groupBy("status").count().collect()}
    assert abs(mix["delivered"] - 0.65) < 0.02 and abs(mix["cancelled"] - 0.05) < 0.01
    rng = po.agg(F.min("order_date").alias("a"), F.max("order_date").alias("b")).first()
    assert rng.a >= dt.date(2024, 10, 1) and rng.b <= dt.date(2025, 3, 31)
    late = po.where("status = 'delivered'").select(
        F.datediff("actual_delivery_date", "expected_delivery_date").alias("d"))
    s = late.agg(F.min("d"), F.max("d"), F.avg("d")).first()
    assert s[0] == -3 and s[1] == 10 and abs(s[2] - 3.5) < 0.3


def test_month_shares_follow_weights():
    shares = {lo.month: sh for lo, _, sh in G.month_shares()}
    assert abs(shares[12] - 0.210) < 0.002 and abs(shares[1] - 0.126) < 0.002


def test_chronically_low_products(spark):
    t = G.build_all(spark)
    inv = t["inventory_snapshots"]
    low = G.pick_low_stock(t["products"])
    per = (inv.join(low, "product_id").groupBy("product_id")
              .agg(F.count_if(F.col("quantity_on_hand") < F.col("reorder_point")).alias("n"),
                   F.count("*").alias("m")).collect())
    assert len(per) == 5 and all(r.n == r.m for r in per)
    assert inv.agg(F.max("snapshot_date")).first()[0] == dt.date(2025, 2, 24)


def test_on_time_share_near_four_in_fourteen(spark):
    po = G.build_all(spark, scale=50)["purchase_orders"]
    rec = po.where("actual_delivery_date IS NOT NULL")
    share = rec.where("actual_delivery_date <= expected_delivery_date").count() / rec.count()
    assert abs(share - 4 / 14) < 0.02


def test_every_result_runs_on_a_generated_reference_star(spark):
    """The results layer works on the reference's own data model (string keys,
    reference regions and months) - what a user of the reference would load."""
    import uuid

    from quartermaster.plans.results import RESULTS
    from quartermaster.session import scratch_path
    from quartermaster.sources.conform import Star, materialize_star
    t = G.build_all(spark, scale=4)
    star = materialize_star(Star(spark=spark, source="generated", **t),
                            scratch_path(spark, f"gen-star-{uuid.uuid4().hex[:8]}"))
    counts = {name: fn(star).count() for name, fn in RESULTS.items()}
    assert counts["row_counts"] == 4 and counts["kpi_total_spend"] == 5
    assert counts["q_warehouse_low_stock_all"] == 4
    drivers = RESULTS["q_spend_drivers"](star, base="2024-10", compare=("2024-11", "2024-12"))
    assert drivers.count() > 0
    assert RESULTS["q_order_value_by_eta_month"](star, month="2025-01").first().order_value > 0
