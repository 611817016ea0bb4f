"""Every guard fires on a row that breaks its rule, NULLs included."""

from copy import copy

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quartermaster.operators import metrics as M
from quartermaster.operators import quality as Q
from quartermaster.operators.enrich import ORDER_DIMS

STATUSES = ("delivered", "in_transit", "delayed", "cancelled")
WAREHOUSES = ("Chicago", "Atlanta", "Seattle", "Dallas")


def changed(star, table, where, **values):
    """The star with ``values`` set in the rows of ``table`` that ``where`` keeps."""
    df, out = getattr(star, table), copy(star)
    for c, v in values.items():
        kind = df.schema[c].dataType
        df = df.withColumn(c, F.when(F.expr(where), F.lit(v).cast(kind)).otherwise(F.col(c)))
    setattr(out, table, df)
    out._bounded = {}
    return out


BREAK = [
    ("purchase_orders", "status_not_allowed", {"status": "lost"}),
    ("purchase_orders", "status_not_allowed", {"status": None}),
    ("purchase_orders", "actual_date_iff_delivered", {"actual_delivery_date": None}),
    ("purchase_orders", "quantity_not_positive", {"quantity": 0}),
    ("purchase_orders", "quantity_not_positive", {"quantity": None}),
    ("purchase_orders", "unit_cost_not_positive", {"unit_cost": None}),
    ("purchase_orders", "expected_before_order", {"expected_delivery_date": "2020-01-01"}),
    ("purchase_orders", "expected_before_order", {"expected_delivery_date": None}),
    ("suppliers", "rating_out_of_range", {"reliability_rating": 5.5}),
    ("suppliers", "rating_out_of_range", {"reliability_rating": None}),
    ("suppliers", "lead_time_not_positive", {"lead_time_days": None}),
    ("suppliers", "region_missing", {"region": None}),
    ("inventory_snapshots", "warehouse_not_allowed", {"warehouse": None}),
    ("inventory_snapshots", "on_hand_negative", {"quantity_on_hand": -1}),
    ("inventory_snapshots", "on_hand_negative", {"quantity_on_hand": None}),
    ("inventory_snapshots", "on_order_while_not_low", {"quantity_on_order": 5, "quantity_on_hand": 900}),
]
FIRST = {"purchase_orders": "order_id = 'PO-00001'", "suppliers": "supplier_id = 'SUP-001'",
         "inventory_snapshots": "snapshot_date = date'2024-11-04'"}


@pytest.mark.parametrize("table, check, values", BREAK)
def test_domain_check_fires(golden, table, check, values):
    found = Q.domain_checks(changed(golden, table, FIRST[table], **values), STATUSES, WAREHOUSES)
    assert {(r.table_name, r.check): r.violations for r in found.collect()}[table, check] == 1


def test_allowed_values(golden):
    star = changed(golden, "purchase_orders", FIRST["purchase_orders"], status="lost")
    assert rows(Q.check_domain(star.purchase_orders, "status", STATUSES)) == [("lost", 1)]
    star = changed(golden, "inventory_snapshots", FIRST["inventory_snapshots"], warehouse=None)
    assert rows(Q.check_domain(star.inventory_snapshots, "warehouse", WAREHOUSES)) == [(None, 1)]


def test_orphans_and_null_keys(golden):
    star = changed(golden, "purchase_orders", FIRST["purchase_orders"], supplier_id="SUP-999", product_id=None)
    got = {r.relationship: r.orphan_rows for r in Q.orphan_report(star).collect()}
    assert got == {"purchase_orders->suppliers": 1, "purchase_orders->products": 1,
                   "inventory_snapshots->products": 0, "products->suppliers": 0}


def test_paths(golden):
    star = changed(golden, "purchase_orders", FIRST["purchase_orders"], supplier_id="SUP-002")
    assert tuple(Q.path_mismatches(star).first()) == (6, 1, 0)
    star = changed(golden, "purchase_orders", FIRST["purchase_orders"], supplier_id=None)
    assert tuple(Q.path_mismatches(star).first()) == (6, 1, 0)
    star = changed(golden, "purchase_orders", FIRST["purchase_orders"], product_id="PROD-999")
    assert tuple(Q.path_mismatches(star).first()) == (6, 0, 1)


def test_uniqueness_of_the_order_key(golden):
    star = copy(golden)
    star.purchase_orders = golden.purchase_orders.unionByName(golden.purchase_orders.limit(1))
    got = {r.table_name: (r.duplicate_keys, r.rows_of_duplicates) for r in Q.uniqueness_report(star).collect()}
    assert got["purchase_orders"] == (1, 2) and got["suppliers"] == (0, 0)


@pytest.mark.parametrize("strategy", ["broadcast", "eager"])
def test_keep_empty_keeps_groups_without_a_qualifying_row(golden, strategy):
    star = changed(golden, "purchase_orders", "supplier_id = 'SUP-003'", status="cancelled")
    got = M.star_metrics(star, star.purchase_orders, ORDER_DIMS, [M.total_spend()], ["region"], keep_empty=True,
                         strategy=strategy)
    assert {r.region: r.total_spend for r in got.collect()} == {"Africa": None, "Europe": 649.95, "North America": 310.0}
    without = M.star_metrics(star, star.purchase_orders, ORDER_DIMS, [M.total_spend()], ["region"], strategy=strategy)
    assert {r.region for r in without.collect()} == {"Europe", "North America"}


def test_keep_empty_over_rows(spark):
    df = spark.createDataFrame([("a", 1, "10.00", "delivered"), ("b", 2, "5.00", "cancelled")],
                               "k string, quantity int, unit_cost string, status string").withColumn(
        "unit_cost", F.col("unit_cost").cast("decimal(12,2)"))
    assert rows(M.metrics(df, [M.total_spend()], ["k"], keep_empty=True)) == [("a", 10.0), ("b", None)]
    assert rows(M.metrics(df, [M.total_spend()], ["k"])) == [("a", 10.0)]


def test_one_name_for_two_filters_is_an_error(golden):
    one = M.measure("x", {"n": ("count", F.lit(1))}, lambda p: p("n"), where=F.col("quantity") > 1, where_key="f")
    two = M.measure("y", {"n": ("count", F.lit(1))}, lambda p: p("n"), where=F.col("quantity") > 2, where_key="f")
    with pytest.raises(ValueError, match="two filters"):
        M.metrics(golden.purchase_orders, [one, two])
