"""Named results: every query and question of SURVEY §2.10.

Each builder takes a conformed ``Star`` and returns a lazy DataFrame. Column
names equal the reference's aliases. Every aggregate goes through the measure
catalogue (``operators.metrics``) so a measure is defined once.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import metrics as M
from ..operators.analysis import drivers, mom_change, rank_suppliers, top_n
from ..operators.enrich import (INVENTORY_DIMS, ORDER_DIMS, enrich_inventory, product_dim,
                                supplier_dim)
from ..operators.joins import latest_only, zero_fill
from ..sources.conform import (BASE_MONTH, BENCH_REGION, COMPARE_FIRST, COMPARE_LAST,
                               ETA_MONTH, MAX_LEAD_DAYS, WAREHOUSES)


def _orders(star, measures, by=(), where=None, dim_where=None, fact=None, keep_empty=False):
    return M.star_metrics(star, fact if fact is not None else star.purchase_orders, ORDER_DIMS,
                          measures, by, where, dim_where, keep_empty)


def _orders_by_month(star):
    return star.purchase_orders.withColumn("order_month", X.month_start("order_date"))


def _latest_inventory(star):
    return latest_only(star.inventory_snapshots, "snapshot_date")


def _inventory(star, measures, by=(), where=None, dim_where=None, fact=None):
    return M.star_metrics(star, fact if fact is not None else _latest_inventory(star),
                          INVENTORY_DIMS, measures, by, where, dim_where)


# ---- setup / exploration ---------------------------------------------------------
def row_counts(star) -> DataFrame:
    """One row per star table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in star.tables().items()]
    return reduce(DataFrame.unionByName, parts)


def suppliers_directory(star) -> DataFrame:
    """All suppliers ordered by region, name."""
    return star.suppliers.orderBy("region", "supplier_name")


def product_category_stats(star) -> DataFrame:
    return M.metrics(star.products, M.cost_stats(), ["category"]).orderBy("category")


def order_status_distribution(star) -> DataFrame:
    return (M.metrics(star.purchase_orders,
                      [M.order_count(), M.avg_quantity(), M.order_value_total("total_spend")],
                      ["status"])
             .orderBy(F.col("order_count").desc(), "status"))


def late_deliveries_by_region(star) -> DataFrame:
    return (_orders(star, [M.late_orders("delayed_orders"), M.avg_days_late()], ["region"])
            .orderBy(F.col("delayed_orders").desc(), "region"))


# ---- dashboard datasets (H1) ---------------------------------------------------
def kpi_total_orders(star) -> DataFrame:
    return _orders(star, [M.order_count("total_orders")], ["region"])


def kpi_on_time_rate(star) -> DataFrame:
    return _orders(star, [M.on_time_rate("on_time_pct", scale=1, digits=3)], ["region"])


def kpi_total_spend(star) -> DataFrame:
    return _orders(star, [M.total_spend()], ["region"])


def kpi_low_stock(star) -> DataFrame:
    return _inventory(star, [M.low_stock_count()], ["region"])


def spend_by_region(star) -> DataFrame:
    return kpi_total_spend(star).orderBy(F.col("total_spend").desc(), "region")


def orders_over_time(star) -> DataFrame:
    return (_orders(star, [M.order_count()], ["region", "order_month", "status"],
                    fact=_orders_by_month(star))
            .orderBy("order_month", "status", "region"))


def delivery_by_supplier(star) -> DataFrame:
    return (_orders(star, [M.avg_variance_days()], ["region", "supplier_name"])
            .orderBy("avg_days_variance", "supplier_name"))


def top_products_by_spend(star, n: int = 10, regions=None) -> DataFrame:
    """O4. ``regions`` (T6 ``refilter_before_limit``) filters before the limit, so
    a region selection still yields the top ``n`` of that selection."""
    agg = _orders(star, [M.total_quantity(), M.total_spend()],
                  ["region", "product_name", "category", "supplier_name"],
                  where=M.NOT_CANCELLED(),
                  dim_where={"suppliers": X.member_of("region", regions)} if regions else None)
    return top_n(agg, [F.col("total_spend").desc(), "product_name", "supplier_name", "region",
                       "category"], n)


def monthly_orders_by_status(star) -> DataFrame:
    return (M.metrics(_orders_by_month(star), [M.order_count()], ["order_month", "status"])
             .orderBy("order_month", "status"))


# ---- benchmark questions (ground truth) ----------------------------------------
def bm_suppliers_in_region(star, region: str = BENCH_REGION) -> DataFrame:
    return M.metrics(star.suppliers, [M.count_rows("supplier_count")], [],
                     where=F.col("region") == region)


def bm_avg_order_value(star) -> DataFrame:
    return M.metrics(star.purchase_orders, [M.avg_order_value()])


def bm_worst_warehouse(star) -> DataFrame:
    """The reference joins products only as an existence check -> left_semi."""
    inv = _latest_inventory(star).join(star.products.select("product_id"), "product_id", "left_semi")
    agg = M.metrics(inv, [M.low_stock_count("low_stock_items")], ["warehouse"])
    return top_n(agg, [F.col("low_stock_items").desc(), "warehouse"], 1)


def bm_monthly_spend(star) -> DataFrame:
    return (_orders(star, [M.total_spend("monthly_spend")], ["order_month"], fact=_orders_by_month(star))
            .orderBy("order_month"))


def bm_best_suppliers(star, include_unreceived: bool = False) -> DataFrame:
    """W2/T13 ranking; T12 option ``include_unreceived`` keeps suppliers with no
    receipt (rate NULL, ranked last) by left-joining the supplier list."""
    agg = _orders(star, [M.on_time_rate("on_time_pct")], ["supplier_name", "reliability_rating"])
    if include_unreceived:
        names = star.suppliers.select("supplier_name", "reliability_rating").distinct()
        agg = names.join(agg, ["supplier_name", "reliability_rating"], "left")
    return rank_suppliers(agg)


def bm_best_suppliers_all(star) -> DataFrame:
    """T12 option: every supplier, those without receipts last with a NULL rate."""
    return bm_best_suppliers(star, include_unreceived=True)


# ---- tutorial / common questions -------------------------------------------------
def q_order_count(star) -> DataFrame:
    return M.metrics(star.purchase_orders, [M.order_count()])


def q_overall_on_time(star) -> DataFrame:
    return M.metrics(star.purchase_orders, [M.on_time_rate()])


def q_most_delayed_supplier(star) -> DataFrame:
    agg = _orders(star, [M.delayed_count()], ["supplier_name"])
    return top_n(agg, [F.col("delayed_orders").desc(), "supplier_name"], 1)


def q_monthly_spend_by_category(star) -> DataFrame:
    return (_orders(star, [M.total_spend()], ["order_month", "category"], fact=_orders_by_month(star))
            .orderBy("order_month", "category"))


def q_below_reorder_now(star, per_item: bool = False) -> DataFrame:
    """M3+M4 rows now. ``per_item`` (T17 option): each product-warehouse's own
    latest snapshot instead of the global latest date."""
    latest = latest_only(star.inventory_snapshots, "snapshot_date",
                         per=["product_id", "warehouse"] if per_item else None)
    return (enrich_inventory(star, dims=("products",), synonyms=False, rows=latest.where(M.LOW_STOCK()))
            .select("snapshot_date", "product_id", "product_name", "warehouse", "quantity_on_hand",
                    "reorder_point", "quantity_on_order")
            .orderBy("product_id", "warehouse"))


def q_region_lead_vs_delivery(star) -> DataFrame:
    """Contracted lead time at supplier grain; delivery measures per order."""
    contracted = M.metrics(star.suppliers, [M.avg_contracted_lead_days()], ["region"])
    delivery = _orders(star, [M.avg_actual_lead_days(), M.on_time_rate("on_time_pct"),
                              M.avg_variance_days()], ["region"])
    return contracted.join(delivery, "region", "left").orderBy("region")


def q_spend_drivers(star, base=BASE_MONTH, compare=(COMPARE_FIRST, COMPARE_LAST),
                    normalise: str = "per_month", by=("region", "category")) -> DataFrame:
    """V1: spend change base month -> compare months by region and category (or by one of them).

    The two window totals are two filtered measures of one aggregation, so the
    star is scanned once and, with large dimensions, pre-aggregated per key.
    """
    agg = _spend_windows(star, list(by), base, compare)
    n_cmp = _months_between(compare[0], compare[1])
    return (drivers(agg, list(by), "__base", "__cmp", 1, n_cmp, normalise)
            .orderBy(F.col("delta_spend").desc(), *by))


def spend_driver_cube(star, sets=(("region", "category"), ("region",), ("category",), ()), base=BASE_MONTH,
                      compare=(COMPARE_FIRST, COMPARE_LAST)) -> DataFrame:
    """V1 over several keys: the spend change of every grouping set, from one scan of the order lines.

    The parts per (region, category) are merged per set; the total change, of which each
    row is a share, is merged from the same parts.
    """
    parts = _spend_windows(star, ["region", "category"], base, compare, parts_only=True)
    names = {"__base": "b", "__cmp": "c"}
    rows = M.grouping_sets(parts, sets).withColumnsRenamed(names)
    n = _months_between(compare[0], compare[1])
    change = lambda b, c: F.coalesce(c, F.lit(0)) - F.coalesce(b, F.lit(0)) * n
    b, c = (F.sum(m.col("v")) for m in parts.measures)
    total = parts.df.agg(change(b, c).alias("t")).scalar()
    d = change(F.col("b"), F.col("c"))
    out = lambda x: X.money_out(F.coalesce(x, F.lit(0)))
    return rows.select(
        "grouped_by", "region", "category", out(F.col("b")).alias("base_spend"), out(F.col("c")).alias("compare_spend"),
        F.round(F.try_divide(d.cast("decimal(38,18)"), F.lit(n).cast("decimal(38,0)")), 2).cast("double").alias("delta_spend"),
        F.round(F.try_divide(d.cast("decimal(38,18)"), total.cast("decimal(38,2)")), 4).cast("double").alias("share_of_change"))


def _spend_windows(star, by, base, compare, parts_only=False):
    """Spend of the base month and of the compare months, two filtered measures of one aggregation."""
    def window_sum(name, cond, key):
        return M.measure(name, {"v": ("sum", X.order_value())}, lambda p: p("v"),
                         where=M.NOT_CANCELLED() & cond, where_key=key)
    return M.star_metrics(star, star.orders_of(base, compare[1]), ORDER_DIMS,
                          [window_sum("__base", X.in_month("order_date", base), "base"),
                           window_sum("__cmp", X.in_months("order_date", *compare), "cmp")],
                          by, where=X.in_months("order_date", base, compare[1]), parts_only=parts_only)


def x_spend_volume_price(star, base=BASE_MONTH, compare=(COMPARE_FIRST, COMPARE_LAST)) -> DataFrame:
    """V1 extra split: per product, spend change = volume effect + price effect.

    volume = (q_compare - q_base) x base average price; price = the rest, i.e.
    (compare average price - base average price) x q_compare. Totals per
    window (no per-month scaling); a product new in the compare window is all
    volume effect.
    """
    def part(name, cond, key, expr, fn="sum"):
        return M.measure(name, {"v": (fn, expr)}, lambda p: p("v"),
                         where=M.NOT_CANCELLED() & cond, where_key=key)
    wb, wc = X.in_month("order_date", base), X.in_months("order_date", *compare)
    agg = M.metrics(star.orders_of(base, compare[1]),
                    [part("__sb", wb, "b", X.order_value()), part("__sc", wc, "c", X.order_value()),
                     part("__qb", wb, "bq", F.col("quantity").cast("bigint")),
                     part("__qc", wc, "cq", F.col("quantity").cast("bigint"))],
                    ["product_id"], where=X.in_months("order_date", base, compare[1]))
    zero = F.lit(0).cast("decimal(38,2)")
    sb, sc = F.coalesce("__sb", zero), F.coalesce("__sc", zero)
    qb, qc = F.coalesce("__qb", F.lit(0)), F.coalesce("__qc", F.lit(0))
    # Each effect is one exact division rounded once (no intermediate rounding):
    # volume = sb*(qc-qb)/qb, price = ((sc-sb)*qb - sb*(qc-qb))/qb.
    def once(num):
        return F.round(F.try_divide(num.cast("decimal(38,18)"), qb.cast("decimal(38,0)")), 2)
    vol = F.when(qb == 0, F.round(sc, 2)).otherwise(once(sb * (qc - qb)))
    price = F.when(qb == 0, F.round(sc - sc, 2)).otherwise(once((sc - sb) * qb - sb * (qc - qb)))
    out = agg.select("product_id", sb.alias("__b"), sc.alias("__c"), vol.alias("__v"), price.alias("__p"))
    pd_ = product_dim(star).select("product_id", "product_name", "category")
    out = out.join(F.broadcast(pd_) if star.small("products") else pd_, "product_id")
    return out.select("product_id", "product_name", "category",
                      X.money_out("__b").alias("base_spend"), X.money_out("__c").alias("compare_spend"),
                      F.col("__v").cast("double").alias("volume_effect"),
                      F.col("__p").cast("double").alias("price_effect"))


def q_region_lead_weighted(star) -> DataFrame:
    """T9 option: contracted lead time weighted by orders (supplier grain is the default).

    Orders are counted per supplier first (partial aggregation), so the join
    with suppliers carries one row per supplier; the weighted mean is
    sum(lead x orders) / sum(orders).
    """
    per_supplier = star.purchase_orders.groupBy("supplier_id").agg(F.count(F.lit(1)).alias("__n"))
    dim = supplier_dim(star).select("supplier_id", "region", "lead_time_days")
    rows = per_supplier.join(F.broadcast(dim) if star.small("suppliers") else dim, "supplier_id")
    weighted = M.measure("avg_contracted_lead_days",
                         {"d": ("sum", F.col("lead_time_days").cast("bigint") * F.col("__n")),
                          "n": ("sum", F.col("__n"))},
                         lambda p: X.avg_exact(p("d"), p("n"), 1))
    return M.metrics(rows, [weighted], ["region"])


def _months_between(first: str, last: str) -> int:
    y0, m0 = map(int, first.split("-"))
    y1, m1 = map(int, last.split("-"))
    return (y1 - y0) * 12 + (m1 - m0) + 1


def q_top_spend_region(star) -> DataFrame:
    return top_n(kpi_total_spend(star), [F.col("total_spend").desc(), "region"], 1)


def q_worst_suppliers(star) -> DataFrame:
    agg = _orders(star, [M.on_time_rate("on_time_pct"), M.avg_variance_days()], ["supplier_name"])
    return agg.orderBy(F.col("on_time_pct").asc_nulls_last(), F.col("avg_days_variance").desc(),
                       "supplier_name")


def q_order_value_by_eta_month(star, month: str = ETA_MONTH) -> DataFrame:
    # an order is expected within MAX_LEAD_DAYS of its date (conform's formula), so
    # only the order months that reach into the ETA month are opened
    first = dt.date.fromisoformat(month + "-01") - dt.timedelta(days=MAX_LEAD_DAYS)
    return M.metrics(star.orders_of(f"{first:%Y-%m}", month), [M.order_value_total("order_value")],
                     where=X.in_month("expected_delivery_date", month))


def q_warehouse_low_stock_all(star, warehouses=WAREHOUSES) -> DataFrame:
    members = star.spark.createDataFrame([(w,) for w in warehouses], "warehouse string")
    agg = M.metrics(_latest_inventory(star), [M.low_stock_count()], ["warehouse"])
    return zero_fill(members, agg, "warehouse", 0).orderBy("warehouse")


# ---- extensions (X) ------------------------------------------------------------
def x_spend_mom_change(star) -> DataFrame:
    monthly = (_orders_by_month(star).where(M.NOT_CANCELLED())
               .groupBy("order_month").agg(F.sum(X.order_value()).alias("monthly_spend")))
    return mom_change(monthly, "order_month", "monthly_spend").orderBy("order_month")


def x_counter_all_regions(star) -> DataFrame:
    """Per-region counters plus the all-regions value, ratio re-aggregated."""
    from ..operators.dashboard import counter
    return counter(star)


RESULTS = {
    "row_counts": row_counts,
    "suppliers_directory": suppliers_directory,
    "product_category_stats": product_category_stats,
    "order_status_distribution": order_status_distribution,
    "late_deliveries_by_region": late_deliveries_by_region,
    "kpi_total_orders": kpi_total_orders,
    "kpi_on_time_rate": kpi_on_time_rate,
    "kpi_total_spend": kpi_total_spend,
    "kpi_low_stock": kpi_low_stock,
    "spend_by_region": spend_by_region,
    "orders_over_time": orders_over_time,
    "delivery_by_supplier": delivery_by_supplier,
    "top_products_by_spend": top_products_by_spend,
    "monthly_orders_by_status": monthly_orders_by_status,
    "bm_suppliers_in_region": bm_suppliers_in_region,
    "bm_avg_order_value": bm_avg_order_value,
    "bm_worst_warehouse": bm_worst_warehouse,
    "bm_monthly_spend": bm_monthly_spend,
    "bm_best_suppliers": bm_best_suppliers,
    "bm_best_suppliers_all": bm_best_suppliers_all,
    "q_order_count": q_order_count,
    "q_overall_on_time": q_overall_on_time,
    "q_most_delayed_supplier": q_most_delayed_supplier,
    "q_monthly_spend_by_category": q_monthly_spend_by_category,
    "q_below_reorder_now": q_below_reorder_now,
    "q_region_lead_vs_delivery": q_region_lead_vs_delivery,
    "q_spend_drivers": q_spend_drivers,
    "q_top_spend_region": q_top_spend_region,
    "q_worst_suppliers": q_worst_suppliers,
    "q_order_value_by_eta_month": q_order_value_by_eta_month,
    "q_warehouse_low_stock_all": q_warehouse_low_stock_all,
    "x_spend_mom_change": x_spend_mom_change,
    "x_counter_all_regions": x_counter_all_regions,
    "x_spend_volume_price": x_spend_volume_price,
    "q_region_lead_weighted": q_region_lead_weighted,
}
