"""Registered queries that run through the trusted SQL functions (§2.14)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ..functions import sqlfuncs
from ..sources.conform import ETA_MONTH, load_star
from . import oracle as O

AS_OF = ETA_MONTH + "-01"   # fixed value: as-of date for the low-stock function


def _ready(spark, sf_dir) -> str:
    sqlfuncs.register(spark, load_star(spark, sf_dir))
    return sqlfuncs.PREFIX


def f_spend_by_region(spark, sf_dir) -> DataFrame:
    p = _ready(spark, sf_dir)
    return spark.sql(f"SELECT * FROM {p}spend_by_region(true)")


def f_order_value_all_statuses(spark, sf_dir) -> DataFrame:
    p = _ready(spark, sf_dir)
    return spark.sql(f"SELECT * FROM {p}spend_by_region(false)")


def f_otd_rate_by_supplier(spark, sf_dir) -> DataFrame:
    p = _ready(spark, sf_dir)
    return spark.sql(f"""
        SELECT s.supplier_name, {p}otd_rate(SUM(po.on_time), SUM(po.received)) AS on_time_pct
        FROM (SELECT supplier_id, COUNT_IF(actual_delivery_date <= expected_delivery_date) AS on_time,
                     COUNT(actual_delivery_date) AS received
              FROM {p}purchase_orders WHERE actual_delivery_date IS NOT NULL GROUP BY supplier_id) po
        JOIN {p}suppliers s ON po.supplier_id = s.supplier_id
        GROUP BY s.supplier_name""")


def f_monthly_orders_by_status(spark, sf_dir) -> DataFrame:
    p = _ready(spark, sf_dir)
    return spark.sql(f"SELECT * FROM {p}monthly_orders_by_status()")


def f_low_stock_as_of(spark, sf_dir) -> DataFrame:
    return sqlfuncs.low_stock_as_of(spark, dt.date.fromisoformat(AS_OF), _ready(spark, sf_dir))


def f_low_stock_function(spark, sf_dir) -> DataFrame:
    """The same through the SQL table function."""
    p = _ready(spark, sf_dir)
    return spark.sql(f"SELECT * FROM {p}low_stock_as_of(DATE'{AS_OF}')")


SQLFUNC_QUERIES = {
    "f_spend_by_region": f_spend_by_region,
    "f_order_value_all_statuses": f_order_value_all_statuses,
    "f_otd_rate_by_supplier": f_otd_rate_by_supplier,
    "f_monthly_orders_by_status": f_monthly_orders_by_status,
    "f_low_stock_as_of": f_low_stock_as_of,
    "f_low_stock_function": f_low_stock_function,
}

SQLFUNC_ORACLE = {
    "f_spend_by_region": O.ORACLE["kpi_total_spend"],
    "f_order_value_all_statuses": O.with_star(
        f"SELECT region, {O.money(f'sum({O.VALUE})')} AS total_spend FROM pos GROUP BY region"),
    "f_otd_rate_by_supplier": O.with_star(f"""
        SELECT supplier_name, {O.rdiv(f'{O.ON_TIME} * 100', O.RECEIVED, 1)} AS on_time_pct
        FROM pos WHERE actual_delivery_date IS NOT NULL GROUP BY supplier_name"""),
    "f_monthly_orders_by_status": O.ORACLE["monthly_orders_by_status"],
    "f_low_stock_as_of": O.with_star(f"""
        SELECT warehouse, count(CASE WHEN quantity_on_hand < reorder_point THEN 1 END) AS low_stock_count
        FROM inventory_snapshots
        WHERE snapshot_date = (SELECT max(snapshot_date) FROM inventory_snapshots
                               WHERE snapshot_date <= DATE '{AS_OF}')
        GROUP BY warehouse"""),
}
SQLFUNC_ORACLE["f_low_stock_function"] = SQLFUNC_ORACLE["f_low_stock_as_of"]
