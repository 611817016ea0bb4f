"""Declared join paths as enrichment operators.

The reference declares four many-to-one relationships and asks for the direct
path ``purchase_orders -> suppliers`` over the two-hop one through products.
Here that choice is made once, in code: orders reach suppliers and products
directly; inventory reaches suppliers only through products (J3, the two
dimensions are joined first). Only the dimensions a caller asks for are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from .metrics import DimSpec

SUPPLIER_COLS = ("supplier_name", "region", "country", "lead_time_days", "reliability_rating")
PRODUCT_COLS = ("product_name", "category", "standard_unit_cost", "weight_kg")


def supplier_dim(star) -> DataFrame:
    return star.suppliers.select("supplier_id", *SUPPLIER_COLS)


def product_dim(star) -> DataFrame:
    # The product's list cost is ``standard_unit_cost``; ``unit_cost`` in an
    # enriched order row is always the order's own price.
    return star.products.select("product_id", "product_name", "category",
                                F.col("unit_cost").alias("standard_unit_cost"), "weight_kg")


def product_supplier_dim(star) -> DataFrame:
    """products ⋈ suppliers keyed by product_id (the inventory -> supplier path)."""
    p = star.products.select("product_id", "product_name", "category",
                             F.col("unit_cost").alias("standard_unit_cost"), "weight_kg", "supplier_id")
    s = supplier_dim(star)
    return p.join(F.broadcast(s) if star.small("suppliers") else s, "supplier_id")


ORDER_DIMS = (
    DimSpec("suppliers", "supplier_id", SUPPLIER_COLS, supplier_dim),
    DimSpec("products", "product_id", PRODUCT_COLS, product_dim),
)

INVENTORY_DIMS = (
    # one row per product, but as wide as products and suppliers together: the
    # broadcast check is made on this joined frame
    DimSpec("products", "product_id", PRODUCT_COLS + ("supplier_id",) + SUPPLIER_COLS,
            product_supplier_dim),
)


def with_synonyms(df: DataFrame) -> DataFrame:
    """Business-term alias columns (pruned by Catalyst when unused)."""
    cols = set(df.columns)
    extra = {}
    if {"quantity", "unit_cost"} <= cols:
        extra["order_value"] = X.order_value()
        extra["price"] = F.col("unit_cost")
    if "expected_delivery_date" in cols:
        extra["eta"] = F.col("expected_delivery_date")
    if "actual_delivery_date" in cols:
        extra["received_date"] = F.col("actual_delivery_date")
    if "quantity_on_hand" in cols:
        extra["stock_level"] = F.col("quantity_on_hand")
    return df.withColumns(extra) if extra else df


def enrich_orders(star, dims=("suppliers", "products"), synonyms: bool = True) -> DataFrame:
    """Order lines with the requested dimensions joined on the direct path."""
    rows = star.purchase_orders
    for d in ORDER_DIMS:
        if d.name in dims:
            f = d.frame(star)
            rows = rows.join(F.broadcast(f) if star.small_frame(d.name, f) else f, d.key)
    return with_synonyms(rows) if synonyms else rows


def enrich_inventory(star, dims=("products", "suppliers"), synonyms: bool = True, rows: DataFrame | None = None
                     ) -> DataFrame:
    """Inventory rows (all, or those given) with product and, through it, supplier attributes."""
    rows = star.inventory_snapshots if rows is None else rows
    if "products" in dims or "suppliers" in dims:
        f = product_supplier_dim(star) if "suppliers" in dims else product_dim(star)
        rows = rows.join(F.broadcast(f) if star.small_frame("products", f) else f, "product_id")
    return with_synonyms(rows) if synonyms else rows
