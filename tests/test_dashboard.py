"""Global filter, cross-filter, formatting, quality checks."""

import pytest
from conftest import rows

from quartermaster.operators import dashboard as D
from quartermaster.operators import quality as Q
from quartermaster.plans import results as R


def test_global_filter(golden):
    ds = D.apply_global_filter(D.datasets(golden), "region", ["Europe"])
    assert rows(ds["spend_by_region"]) == [("Europe", 649.95)]
    assert rows(D.apply_global_filter(D.datasets(golden), "region", [])["kpi_total_orders"]) == \
        rows(R.kpi_total_orders(golden))


def test_global_filter_requires_column(golden):
    with pytest.raises(ValueError):
        D.apply_global_filter({"x": golden.products}, "region", ["Europe"])


def test_cross_filter_same_dataset_only(golden):
    ds = {"wide": D.shared_orders_dataset(golden), "other": R.kpi_total_orders(golden)}
    w = D.cross_filter(ds, {"a": "wide", "b": "wide", "c": "other"}, "wide", {"region": "Africa"})
    assert w["b"].count() == 1 and w["c"].count() == 3


def test_format_measures(golden):
    df = D.format_measures(R.spend_by_region(golden), {"total_spend": "money"})
    assert {r.total_spend_display for r in df.collect()} == {"$60.00", "$649.95", "$310.00"}


def test_guards_on_golden(golden, spark):
    assert all(r.orphan_rows == 0 for r in Q.orphan_report(golden).collect())
    assert all(r.duplicate_keys == 0 for r in Q.uniqueness_report(golden).collect())
    pm = Q.path_mismatches(golden).first()
    assert pm.checked_rows == 6 and pm.mismatches == 0
    dc = {(r.table_name, r.check): r.violations for r in
          Q.domain_checks(golden, ("delivered", "in_transit", "delayed", "cancelled"),
                          ("Chicago", "Atlanta", "Seattle", "Dallas")).collect()}
    assert dc[("purchase_orders", "actual_date_iff_delivered")] == 0
    # stock is only on order for items below their reorder point
    assert dc[("inventory_snapshots", "on_order_while_not_low")] == 0


def test_date_filter_applies_before_aggregation(golden):
    ds = D.date_filtered_datasets(golden, "2024-11", "2024-11")
    assert rows(ds["spend_by_region"]) == [("Europe", 249.95), ("North America", 210.0)]
    # on-time over November orders only: Alpha's PO-00002 late, Beta's PO-00003 early
    assert rows(ds["kpi_on_time_rate"]) == [("Europe", 1.0), ("North America", 0.0)]


def test_restrict_inventory_and_tidy_and_publish(golden, spark):
    import datetime as dt

    from pyspark.sql import functions as F
    early = golden.restrict(inventory_where=F.col("snapshot_date") < F.lit(dt.date(2024, 11, 11)))
    # only the 2024-11-04 snapshot is left: it is the latest, PROD-001 Chicago is low
    assert rows(R.kpi_low_stock(early)) == [("North America", 1)]
    t = D.tidy(R.orders_over_time(golden), "order_month", "order_count", "status")
    assert t.columns == ["order_month", "status", "order_count"]
    D.publish({"spend": R.spend_by_region(golden)}, prefix="qm_test_")
    assert spark.sql("SELECT count(*) AS n FROM qm_test_spend").first().n == 3
