"""Data-quality checks on the star.

Each check is one aggregation per table (violation counts as conditional
counts) - no row is collected, and key checks aggregate before they join.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import assert_unique, orphans


def check_domain(df: DataFrame, col: str, allowed: Sequence) -> DataFrame:
    """Values of ``col`` outside ``allowed`` with their row counts.

    Aggregates first (one row per distinct value), then anti-joins the small
    allowed list, so a hot value costs one partial-aggregate row per task.
    """
    spark = df.sparkSession
    ok = spark.createDataFrame([(v,) for v in allowed], f"{col} string")
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(F.broadcast(ok), col, "left_anti")


def path_mismatches(star, orders: DataFrame | None = None) -> DataFrame:
    """Order lines whose direct supplier differs from the product's supplier.

    ``orders`` (default: the star's) has product_id and supplier_id. It is first
    reduced to distinct (product, supplier) pairs with their line counts (partial
    aggregation absorbs a hot product), so the join with products carries one row
    per pair. One row out: lines checked, mismatching lines, lines whose product
    is unknown.
    """
    lines = star.purchase_orders if orders is None else orders
    pairs = lines.groupBy("product_id", "supplier_id").agg(F.count(F.lit(1)).alias("__n"))
    p = star.products.select("product_id", F.col("supplier_id").alias("__via_product"),
                             F.lit(True).alias("__known"))
    j = pairs.join(F.broadcast(p) if star.small("products") else p, "product_id", "left")
    known = F.coalesce("__known", F.lit(False))
    return j.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("checked_rows"),
                 F.coalesce(F.sum(F.when(known & ~F.col("supplier_id").eqNullSafe(F.col("__via_product")),
                                         F.col("__n"))), F.lit(0)).alias("mismatches"),
                 F.coalesce(F.sum(F.when(~known, F.col("__n"))), F.lit(0)).alias("unknown_product"))


def orphan_report(star) -> DataFrame:
    """Orphan counts for each declared many-to-one relationship (a NULL key is an orphan).

    Fact keys are aggregated first (one row per key with its row count), then
    anti-joined with the dimension keys and the counts summed: the join never
    sees a hot key's rows one by one.
    """
    rels = [("purchase_orders->suppliers", star.purchase_orders, star.suppliers, "supplier_id"),
            ("purchase_orders->products", star.purchase_orders, star.products, "product_id"),
            ("inventory_snapshots->products", star.inventory_snapshots, star.products, "product_id"),
            ("products->suppliers", star.products, star.suppliers, "supplier_id")]
    parts = []
    for name, fact, dim, key in rels:
        keys = fact.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
        lost = orphans(keys, dim, key)
        parts.append(lost.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("orphan_rows"))
                     .select(F.lit(name).alias("relationship"), "orphan_rows"))
    return reduce(DataFrame.unionByName, parts)


# Rows of a task that counts keys, and the most such tasks (more than 200 partitions are sorted as they are written).
KEY_ROWS, KEY_TASKS = 500_000, 200


def _dealt(keys: DataFrame) -> DataFrame:
    """The rows dealt out by all their columns, as one aggregation of nearly unique keys needs them.

    Counted where they are read, such keys fill a task's memory: a split of a
    compressed file may hold tens of millions of them, and none goes before the exchange.
    """
    n = -(-keys.count() // KEY_ROWS)
    return keys.repartition(max(1, min(n, KEY_TASKS)), *keys.columns)


def uniqueness_report(star) -> DataFrame:
    """Duplicate-key counts of every dimension, the snapshot grain and the declared order key."""
    keys = [("suppliers", star.suppliers, ["supplier_id"]), ("products", star.products, ["product_id"]),
            ("inventory_snapshots", star.inventory_snapshots,
             ["snapshot_date", "product_id", "warehouse"]),
            ("purchase_orders", star.purchase_orders, ["order_id", "line_number"])]
    parts = [assert_unique(_dealt(df.select(*key)), key)
             .agg(F.count(F.lit(1)).alias("duplicate_keys"),
                  F.coalesce(F.sum("occurrences"), F.lit(0)).alias("rows_of_duplicates"))
             .select(F.lit(name).alias("table_name"), F.lit(",".join(key)).alias("key"),
                     "duplicate_keys", "rows_of_duplicates")
             for name, df, key in keys]
    return reduce(DataFrame.unionByName, parts)


def _as_rows(agg: DataFrame, table: str) -> DataFrame:
    cols = agg.columns
    return (agg.unpivot([], cols, "check", "violations")
               .select(F.lit(table).alias("table_name"), "check",
                       F.col("violations").cast("bigint").alias("violations")))


def domain_checks(star, statuses: Sequence[str], warehouses: Sequence[str]) -> DataFrame:
    """One pass per table counting rule violations; rows (table, check, n)."""
    def violations(**rules):
        """Rows in which a rule doesn't hold; one that is NULL doesn't hold."""
        return [F.count(F.when(~F.coalesce(holds, F.lit(False)), 1)).alias(name) for name, holds in rules.items()]

    c = F.col
    po_agg = star.purchase_orders.agg(*violations(
        status_not_allowed=c("status").isin(list(statuses)),
        actual_date_iff_delivered=(c("status") == "delivered") == c("actual_delivery_date").isNotNull(),
        quantity_not_positive=c("quantity") > 0,
        unit_cost_not_positive=c("unit_cost") > 0,
        expected_before_order=c("expected_delivery_date") >= c("order_date")))
    s_agg = star.suppliers.agg(*violations(
        rating_out_of_range=c("reliability_rating").between(1.0, 5.0),
        lead_time_not_positive=c("lead_time_days") > 0,
        region_missing=c("region").isNotNull()))
    i_agg = star.inventory_snapshots.agg(*violations(
        warehouse_not_allowed=c("warehouse").isin(list(warehouses)),
        on_hand_negative=c("quantity_on_hand") >= 0,
        on_order_while_not_low=(c("quantity_on_order") <= 0) | (c("quantity_on_hand") < c("reorder_point"))))
    return reduce(DataFrame.unionByName, [_as_rows(po_agg, "purchase_orders"),
                                          _as_rows(s_agg, "suppliers"),
                                          _as_rows(i_agg, "inventory_snapshots")])


def setup_verification(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Actual row counts next to the expected ones."""
    return (counts.join(expected, "table_name", "full")
                  .withColumn("matches", F.coalesce(F.col("row_count") == F.col("expected_rows"),
                                                    F.lit(False))))
