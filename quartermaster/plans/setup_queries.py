"""Registered setup queries: catalog writes, previews and generated panels."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import catalog as C
from ..sources.conform import ORDER_MONTH, SNAPSHOT_WEEKS, load_star
from ..sources.generate import (GEN_WAREHOUSES, LOW_MAX_SHARE, N_LOW, NORMAL_MIN_SHARE, ON_HAND_MAX, REORDER_POINTS,
                                SEED, SNAPSHOT_START_REF, WEEKS, gen_inventory)
from . import oracle as O


def a_data_dictionary(spark, sf_dir) -> DataFrame:
    """The written star as described catalog tables in a
    fresh namespace, descriptions read back from the catalog."""
    ns = C.Namespace(schema=f"qm_{uuid.uuid4().hex[:10]}")
    star = load_star(spark, sf_dir)
    if star.path:
        C.register_star(star, ns)
    else:
        C.save_star(star, ns)
    return C.data_dictionary(spark, ns)


def a_preview_orders(spark, sf_dir) -> DataFrame:
    """Five order lines in a stated order."""
    return C.preview(load_star(spark, sf_dir).purchase_orders, 5)


def g_inventory_panel(spark, sf_dir) -> DataFrame:
    """The seeded inventory generator run over the star's products."""
    return gen_inventory(spark, load_star(spark, sf_dir).products)


def g_inventory_panel_shape(spark, sf_dir) -> DataFrame:
    """Deterministic shape of the generated panel: rows, products, weeks per warehouse."""
    panel = g_inventory_panel(spark, sf_dir)
    return panel.groupBy("warehouse").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("product_id").alias("products"),
        F.count_distinct("snapshot_date").alias("weeks"))


SETUP_QUERIES = {
    "a_data_dictionary": a_data_dictionary,
    "a_preview_orders": a_preview_orders,
    "g_inventory_panel": g_inventory_panel,
    "g_inventory_panel_shape": g_inventory_panel_shape,
}

SETUP_ORACLE = {
    "a_preview_orders": O.with_star("""
        SELECT * FROM purchase_orders ORDER BY order_id, line_number, product_id, supplier_id,
          order_date, expected_delivery_date, actual_delivery_date, quantity, unit_cost, status
        LIMIT 5"""),
    "g_inventory_panel_shape": O.with_star(f"""
        SELECT w.warehouse, count(*) * {SNAPSHOT_WEEKS} AS row_count, count(*) AS products,
               CAST({SNAPSHOT_WEEKS} AS BIGINT) AS weeks
        FROM products p CROSS JOIN (VALUES ('Chicago'), ('Atlanta'), ('Seattle'), ('Dallas')) w(warehouse)
        GROUP BY w.warehouse"""),
}


def _draw(salt: str, *cols: str) -> str:
    text = f"concat_ws('|', '{SEED}', '{salt}', {', '.join(cols)})"
    return f"(CAST(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) AS DOUBLE) / {2 ** 52})"


def _panel_sql() -> str:
    """The inventory generator in SQL: the same draws, product by product."""
    cell = ("product_id", "wi", "w")
    reorder = " ".join(f"WHEN '{k}' THEN {v}" for k, v in REORDER_POINTS.items())
    return O.with_star(f"""
        SELECT CAST(DATE '{SNAPSHOT_START_REF}' + CAST(w * 7 AS INTEGER) AS DATE) AS snapshot_date, product_id, warehouse,
               quantity_on_hand, CAST(rp AS INTEGER) AS reorder_point,
               CAST(CASE WHEN quantity_on_hand < rp THEN rp + floor({_draw('inv.order', *cell)} * (rp * 2 + 1))
                         ELSE 0 END AS INTEGER) AS quantity_on_order
        FROM stock""", ctes=f"""
        low AS (SELECT product_id FROM products ORDER BY {_draw('inv.low', 'product_id')}, product_id LIMIT {N_LOW}),
        cells AS (SELECT p.product_id, CASE category {reorder} ELSE 100 END AS rp, wh.wi, wh.warehouse, t.w,
                         p.product_id IN (SELECT product_id FROM low) AS is_low
                  FROM products p CROSS JOIN (VALUES {', '.join(f"({i}, '{x}')" for i, x in enumerate(GEN_WAREHOUSES))})
                       wh(wi, warehouse) CROSS JOIN range(0, {WEEKS}) t(w)),
        stock AS (SELECT *, CAST(CASE WHEN is_low
                    THEN floor({_draw('inv.low_qty', *cell)} * (floor(rp * {LOW_MAX_SHARE}) + 1))
                    ELSE floor(rp * {NORMAL_MIN_SHARE}) + floor({_draw('inv.qty', *cell)}
                         * ({ON_HAND_MAX} - floor(rp * {NORMAL_MIN_SHARE}) + 1)) END AS INTEGER) AS quantity_on_hand
                  FROM cells)""")


# The declared columns of the stored star with their types, folder keys last.
DECLARED = {
    "suppliers": ("supplier_id bigint", "supplier_name string", "region string", "country string", "lead_time_days int",
                  "reliability_rating double"),
    "products": ("product_id bigint", "product_name string", "category string", "unit_cost decimal(12,2)",
                 "supplier_id bigint", "weight_kg double"),
    "purchase_orders": ("order_id bigint", "line_number int", "product_id bigint", "supplier_id bigint",
                        "order_date date", "expected_delivery_date date", "actual_delivery_date date", "quantity int",
                        "unit_cost decimal(12,2)", "status string", f"{ORDER_MONTH} string"),
    "inventory_snapshots": ("product_id bigint", "warehouse string", "quantity_on_hand int", "reorder_point int",
                            "quantity_on_order int", "snapshot_date date"),
}
FOLDER_KEYS = {("purchase_orders", ORDER_MONTH), ("inventory_snapshots", "snapshot_date")}


def _dictionary_sql() -> str:
    def text(s):
        return "NULL" if s is None else "'" + s.replace("'", "''") + "'"

    rows = []
    for table, columns in DECLARED.items():
        for column in columns:
            name, kind = column.split()
            comment = None if (table, name) in FOLDER_KEYS else C.COLUMN_COMMENTS[table].get(name)
            rows.append(f"({text(table)}, {text(name)}, {text(kind)}, {text(comment)}, {text(C.TABLE_COMMENTS[table])})")
    return f"SELECT * FROM (VALUES {', '.join(rows)}) d(table_name, column_name, data_type, comment, table_comment)"


SETUP_ORACLE["g_inventory_panel"] = _panel_sql()
SETUP_ORACLE["a_data_dictionary"] = _dictionary_sql()
