"""Trusted SQL functions: SQL UDFs and SQL table functions.

The reference's "SQL queries and functions" slot holds trusted, reusable SQL.
Here they are Spark SQL functions over the star's views; the analyzer inlines
a SQL function's body into the calling plan, so they cost nothing at run time
(no Python, no serialisation) and Catalyst optimises through them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

PREFIX = "qm_"


def _defs(p: str) -> list[str]:
    return [
        # M2 as a scalar function of its two parts (guarded, percent, 1 dp).
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {p}otd_rate(on_time BIGINT, received BIGINT)
            RETURNS DOUBLE
            RETURN CAST(ROUND(TRY_DIVIDE(CAST(on_time AS DECIMAL(20,0)) * 100,
                                         CAST(received AS DECIMAL(20,0))), 1) AS DOUBLE)""",
        # Exact line value.
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {p}order_value(quantity INT, unit_cost DECIMAL(12,2))
            RETURNS DECIMAL(23,2)
            RETURN CAST(quantity AS DECIMAL(10,0)) * unit_cost""",
        # Trusted query 1 as a table function; cancelled orders excluded unless asked.
        # Lines are summed per supplier before the join, so a hot supplier's
        # lines never meet in one task.
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {p}spend_by_region(exclude_cancelled BOOLEAN)
            RETURNS TABLE (region STRING, total_spend DOUBLE)
            RETURN SELECT s.region, CAST(ROUND(SUM(po.spend), 2) AS DOUBLE)
                   FROM (SELECT supplier_id, status, SUM({p}order_value(quantity, unit_cost)) AS spend
                         FROM {p}purchase_orders GROUP BY supplier_id, status) po
                   JOIN {p}suppliers s ON po.supplier_id = s.supplier_id
                   WHERE NOT exclude_cancelled OR po.status != 'cancelled'
                   GROUP BY s.region""",
        # Trusted query 2 as a table function.
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {p}monthly_orders_by_status()
            RETURNS TABLE (order_month DATE, status STRING, order_count BIGINT)
            RETURN SELECT TRUNC(order_date, 'MM'), status, COUNT(*)
                   FROM {p}purchase_orders GROUP BY 1, 2""",
        # Low-stock rows per warehouse at the latest snapshot on or before d, one
        # date for all warehouses. A function's parameter can only be used at the
        # top level of its body, so the counts of every date are made first;
        # LOW_STOCK_AS_OF below reads one date only.
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {p}low_stock_as_of(d DATE)
            RETURNS TABLE (warehouse STRING, low_stock_count BIGINT)
            RETURN SELECT EXPLODE(MAX_BY(counts, snapshot_date)) AS (warehouse, low_stock_count)
                   FROM (SELECT snapshot_date, MAP_FROM_ENTRIES(COLLECT_LIST(STRUCT(warehouse, n_low))) AS counts
                         FROM (SELECT snapshot_date, warehouse,
                                      COUNT_IF(quantity_on_hand < reorder_point) AS n_low
                               FROM {p}inventory_snapshots GROUP BY snapshot_date, warehouse)
                         GROUP BY snapshot_date)
                   WHERE snapshot_date <= d""",
    ]


def register(spark: SparkSession, star, prefix: str = PREFIX) -> None:
    """Expose the star as ``<prefix><table>`` views and create the functions."""
    star.register_views(prefix)
    for ddl in _defs(prefix):
        spark.sql(ddl)


# The same as a parameterised query: the date is known when it is planned, so the
# scalar subquery lists the folders up to it and the scan opens the latest one.
LOW_STOCK_AS_OF = """
    SELECT warehouse, COUNT_IF(quantity_on_hand < reorder_point) AS low_stock_count
    FROM {p}inventory_snapshots
    WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM {p}inventory_snapshots WHERE snapshot_date <= :as_of)
    GROUP BY warehouse"""


def low_stock_as_of(spark: SparkSession, as_of, prefix: str = PREFIX):
    """Low-stock rows per warehouse at the latest snapshot on or before ``as_of``."""
    return spark.sql(LOW_STOCK_AS_OF.format(p=prefix), args={"as_of": as_of})
