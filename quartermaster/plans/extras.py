"""Registered queries beyond §2.10: guards, dashboard ops, evaluation, alerts.

Every query reads the star derived from the given tables; parameters (region
picks, rules, run dates) are small literal inputs applied to that data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import dashboard as D
from ..operators import evaluate as E
from ..operators import metrics as M
from ..operators import quality as Q
from ..operators.enrich import ORDER_DIMS, enrich_orders
from ..operators.summary import Summary, filtered_datasets
from ..sources.conform import STATUSES, WAREHOUSES, load_star
from ..sources.raw import Raw
from . import benchmark as B
from . import oracle as O
from .results import RESULTS, spend_driver_cube

# fixed values: dashboard selections used by the registered filter queries.
GLOBAL_PICK = ("ASIA", "EUROPE")
CROSS_PICK = {"region": "EUROPE"}
COUNTER_PICK = ("AMERICA", "EUROPE")
DATE_PICK = ("2000-01", "2000-06")
# Alert rules: the reference's example (low-stock count above 10) plus an
# on-time floor; evaluated per region and for all regions.
ALERT_RULES = (("low_stock_count", ">", 10.0), ("on_time_pct", "<", 0.3))


def _star(spark: SparkSession, sf_dir: str):
    return load_star(spark, sf_dir)


# ---- guards & quality -----------------------------------------------------------
def j_uniqueness(spark, sf_dir) -> DataFrame:
    return Q.uniqueness_report(_star(spark, sf_dir))


def j_orphans(spark, sf_dir) -> DataFrame:
    return Q.orphan_report(_star(spark, sf_dir))


def j_path_equivalence(spark, sf_dir) -> DataFrame:
    """The supplier each given order line names against its product's supplier.

    The star's own supplier_id is made from the product (conform), so comparing
    that would compare a formula with itself; the given l_suppkey is independent.
    """
    given = Raw(spark, sf_dir).lineitem.select(F.col("l_partkey").alias("product_id"),
                                               F.col("l_suppkey").alias("supplier_id"))
    return Q.path_mismatches(_star(spark, sf_dir), given)


def e_domain_checks(spark, sf_dir) -> DataFrame:
    return Q.domain_checks(_star(spark, sf_dir), STATUSES, WAREHOUSES)


def n_status_domain(spark, sf_dir) -> DataFrame:
    """Statuses outside the allowed list (empty when clean)."""
    return Q.check_domain(_star(spark, sf_dir).purchase_orders, "status", STATUSES)


def n_warehouse_domain(spark, sf_dir) -> DataFrame:
    """Warehouses outside the four allowed ones (empty when clean)."""
    return Q.check_domain(_star(spark, sf_dir).inventory_snapshots, "warehouse", WAREHOUSES)


def e_setup_verification(spark, sf_dir) -> DataFrame:
    """Star row counts against counts expected from the raw tables."""
    star, raw = _star(spark, sf_dir), Raw(spark, sf_dir)
    n_part = raw.part.agg(F.count(F.lit(1)).alias("n"))
    expected = (raw.supplier.agg(F.count(F.lit(1)).alias("n")).select(F.lit("suppliers").alias("table_name"), "n")
                .unionByName(n_part.select(F.lit("products").alias("table_name"), "n"))
                .unionByName(raw.lineitem.agg(F.count(F.lit(1)).alias("n"))
                             .select(F.lit("purchase_orders").alias("table_name"), "n"))
                .unionByName(n_part.select(F.lit("inventory_snapshots").alias("table_name"),
                                           (F.col("n") * len(WAREHOUSES) * 17).alias("n")))
                .withColumnRenamed("n", "expected_rows"))
    return Q.setup_verification(RESULTS["row_counts"](star), expected)


# ---- dashboard operations --------------------------------------------------------
def h_global_filter(spark, sf_dir) -> DataFrame:
    """H2: the region multi-select applied to every dataset; spend chart shown."""
    ds = D.apply_global_filter(D.datasets(_star(spark, sf_dir)), "region", GLOBAL_PICK)
    return ds["spend_by_region"]


def h_global_filter_top10(spark, sf_dir) -> DataFrame:
    """The filter applied to the Top-10 dataset's output (fewer than 10 rows)."""
    ds = D.apply_global_filter(D.datasets(_star(spark, sf_dir)), "region", GLOBAL_PICK)
    return ds["top_products_by_spend"]


def h_date_filter(spark, sf_dir) -> DataFrame:
    """A date-range filter on order rows applied to every dataset (spend shown)."""
    ds = D.date_filtered_datasets(_star(spark, sf_dir), *DATE_PICK)
    return ds["spend_by_region"]


def h_date_filter_otd(spark, sf_dir) -> DataFrame:
    """The on-time KPI under the same date filter (ratio over kept rows)."""
    return D.date_filtered_datasets(_star(spark, sf_dir), *DATE_PICK)["kpi_on_time_rate"]


def h_top10_refiltered(spark, sf_dir) -> DataFrame:
    """T6 option: the region selection applied before the Top-10 limit."""
    return RESULTS["top_products_by_spend"](_star(spark, sf_dir), regions=GLOBAL_PICK)


def h_cross_filter(spark, sf_dir) -> DataFrame:
    """H3/H4: two widgets on the shared orders dataset; picking a region bar in
    one filters the status widget bound to the same dataset."""
    star = _star(spark, sf_dir)
    ds = {"orders_enriched": D.shared_orders_dataset(star)}
    widgets = D.cross_filter(ds, {"spend_bar": "orders_enriched", "status_table": "orders_enriched"},
                             "orders_enriched", CROSS_PICK)
    return M.metrics(widgets["status_table"], [M.order_count(), M.total_spend()], ["status"])


def h_counter_filtered(spark, sf_dir) -> DataFrame:
    """H5: counter values under a region selection (total re-aggregated)."""
    return D.counter(_star(spark, sf_dir), values=COUNTER_PICK)


def h_tidy_wide(spark, sf_dir) -> DataFrame:
    """H6: orders-over-time line chart as a wide month x status frame."""
    star = _star(spark, sf_dir)
    tidy = RESULTS["monthly_orders_by_status"](star)
    return D.tidy(tidy, "order_month", "order_count", "status", wide=True, series_values=STATUSES)


def h_format_top_products(spark, sf_dir) -> DataFrame:
    """H7/P20: the Top-10 table with currency and thousands formatting."""
    top = RESULTS["top_products_by_spend"](_star(spark, sf_dir))
    return D.format_measures(top, {"total_spend": "money", "total_quantity": "count"})


# ---- evaluation ------------------------------------------------------------------
def e_diff_results(spark, sf_dir) -> DataFrame:
    """Spend by region that forgot to exclude cancelled orders vs the truth."""
    star = _star(spark, sf_dir)
    wrong = M.star_metrics(star, star.purchase_orders, ORDER_DIMS,
                           [M.order_value_total("total_spend")], ["region"])
    return E.diff_results(RESULTS["kpi_total_spend"](star), wrong)


def e_score_run(spark, sf_dir) -> DataFrame:
    """The untuned run scored against ground truth (from the recorded runs)."""
    return _both_runs(spark, sf_dir).where(F.col("run_id") == 1)


def _both_runs(spark, sf_dir) -> DataFrame:
    return B.scored_runs(_star(spark, sf_dir), (1, 2))


def e_run_summary(spark, sf_dir) -> DataFrame:
    """Accuracy per run and category against the 80 % mark."""
    return E.run_summary(_both_runs(spark, sf_dir))


def e_compare_runs(spark, sf_dir) -> DataFrame:
    """Which questions the tuned run fixed."""
    runs = _both_runs(spark, sf_dir)
    return E.compare_runs(runs.where("run_id = 1"), runs.where("run_id = 2"))


def e_feedback_summary(spark, sf_dir) -> DataFrame:
    """E5: weekly thumbs-down by failure pattern with the unreviewed queue."""
    return E.feedback_summary(B.feedback_frame(_both_runs(spark, sf_dir)))


def e_alerts(spark, sf_dir) -> DataFrame:
    """Threshold rules over the counter values (per region and total)."""
    star = _star(spark, sf_dir)
    c = D.counter(star)
    values = (c.select("region", "is_total",
                       F.col("low_stock_count").cast("double").alias("low_stock_count"),
                       F.col("on_time_pct").cast("double").alias("on_time_pct"))
               .unpivot(["region", "is_total"], ["low_stock_count", "on_time_pct"], "measure", "value"))
    rules = spark.createDataFrame(list(ALERT_RULES), "measure string, op string, threshold double")
    return E.alerts(values, rules)


def e_review_queue(spark, sf_dir) -> DataFrame:
    """E5: the thumbs-down answers that nobody has reviewed yet."""
    return E.review_queue(B.feedback_frame(_both_runs(spark, sf_dir), reviewed_runs=()))


# ---- other grains, displays and options ------------------------------------------
def x_orders_by_quarter(spark, sf_dir) -> DataFrame:
    """Order counts and spend by calendar quarter."""
    return _by_grain(_star(spark, sf_dir), "quarter")


def x_orders_by_week(spark, sf_dir) -> DataFrame:
    """Order counts and spend by week (Mondays)."""
    return _by_grain(_star(spark, sf_dir), "week")


def _by_grain(star, unit: str) -> DataFrame:
    rows = star.purchase_orders.withColumn("period", X.time_bucket("order_date", unit).cast("date"))
    return M.metrics(rows, [M.order_count(), M.total_spend()], ["period"])


def h_format_rates(spark, sf_dir) -> DataFrame:
    """P20: the on-time KPI as a fraction shown in percent, and suppliers' percents."""
    star = _star(spark, sf_dir)
    fraction = D.format_measures(RESULTS["kpi_on_time_rate"](star), {"on_time_pct": "fraction"})
    percent = D.format_measures(RESULTS["bm_best_suppliers"](star).select(
        F.col("supplier_name").alias("region"), "on_time_pct"), {"on_time_pct": "percent"})
    return fraction.select("region", "on_time_pct", "on_time_pct_display").unionByName(
        percent.select("region", "on_time_pct", "on_time_pct_display"))


def n_synonyms(spark, sf_dir) -> DataFrame:
    """A question in business terms - order value, price, ETA, received date, OTD."""
    rows = enrich_orders(_star(spark, sf_dir), dims=("suppliers",))
    otd = M.metrics(rows, [M.measure_for("OTD rate").alias("otd_rate")], ["region"])
    terms = rows.groupBy("region").agg(
        X.money_out(F.sum("order_value")).alias("order_value"),
        F.max("price").cast("double").alias("highest_price"),
        F.max("eta").alias("last_eta"), F.max("received_date").alias("last_received"))
    return terms.join(otd, "region")


def x_spend_driver_margins(spark, sf_dir) -> DataFrame:
    """V1: the change in spend by region alone and by category alone."""
    cube = spend_driver_cube(_star(spark, sf_dir), (("region",), ("category",)))
    return cube.select(F.col("grouped_by").alias("dimension"), F.coalesce("region", "category").alias("member"),
                       "base_spend", "compare_spend", "delta_spend", "share_of_change")


def _dataset_totals(ds: dict) -> DataFrame:
    """One row per dataset: its rows and the sum of its main value (exact cents or counts)."""
    value = {"kpi_total_orders": "total_orders", "kpi_on_time_rate": "on_time_pct", "kpi_total_spend": "total_spend",
             "kpi_low_stock": "low_stock_count", "spend_by_region": "total_spend", "orders_over_time": "order_count",
             "delivery_by_supplier": "avg_days_variance", "top_products_by_spend": "total_spend"}
    parts = [df.agg(F.count(F.lit(1)).alias("rows"),
                    F.sum(F.col(value[name]).cast("decimal(20,3)")).cast("double").alias("total"))
             .select(F.lit(name).alias("dataset"), "rows", "total") for name, df in ds.items()]
    return reduce(DataFrame.unionByName, parts)


def h_global_filter_all(spark, sf_dir) -> DataFrame:
    """H2: all eight datasets under the region filter, as rows and totals, from the stored summary."""
    summary = Summary(_star(spark, sf_dir)).build()
    return _dataset_totals(filtered_datasets(summary, "region", GLOBAL_PICK))


def h_date_filter_all(spark, sf_dir) -> DataFrame:
    """All eight datasets under the date filter, as rows and totals."""
    return _dataset_totals(D.date_filtered_datasets(_star(spark, sf_dir), *DATE_PICK))


EXTRA_QUERIES = {
    "j_uniqueness": j_uniqueness,
    "j_orphans": j_orphans,
    "j_path_equivalence": j_path_equivalence,
    "n_status_domain": n_status_domain,
    "n_warehouse_domain": n_warehouse_domain,
    "e_domain_checks": e_domain_checks,
    "e_setup_verification": e_setup_verification,
    "h_global_filter": h_global_filter,
    "h_global_filter_top10": h_global_filter_top10,
    "h_top10_refiltered": h_top10_refiltered,
    "h_date_filter": h_date_filter,
    "h_date_filter_otd": h_date_filter_otd,
    "h_cross_filter": h_cross_filter,
    "h_counter_filtered": h_counter_filtered,
    "h_tidy_wide": h_tidy_wide,
    "h_format_top_products": h_format_top_products,
    "e_diff_results": e_diff_results,
    "e_score_run": e_score_run,
    "e_run_summary": e_run_summary,
    "e_compare_runs": e_compare_runs,
    "e_feedback_summary": e_feedback_summary,
    "e_alerts": e_alerts,
    "e_review_queue": e_review_queue,
    "x_orders_by_quarter": x_orders_by_quarter,
    "x_orders_by_week": x_orders_by_week,
    "h_format_rates": h_format_rates,
    "n_synonyms": n_synonyms,
    "x_spend_driver_margins": x_spend_driver_margins,
    "h_global_filter_all": h_global_filter_all,
    "h_date_filter_all": h_date_filter_all,
}


def _in(vals) -> str:
    return "(" + ", ".join(f"'{v}'" for v in vals) + ")"


_STATUS_IN = _in(STATUSES)
_WH_IN = _in(WAREHOUSES)

EXTRA_ORACLE = {
    "j_uniqueness": O.with_star("""
        SELECT 'suppliers' AS table_name, 'supplier_id' AS key, count(*) AS duplicate_keys,
               CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_of_duplicates
        FROM (SELECT count(*) AS n FROM suppliers GROUP BY supplier_id HAVING count(*) > 1)
        UNION ALL SELECT 'products', 'product_id', count(*), CAST(coalesce(sum(n), 0) AS BIGINT)
        FROM (SELECT count(*) AS n FROM products GROUP BY product_id HAVING count(*) > 1)
        UNION ALL SELECT 'inventory_snapshots', 'snapshot_date,product_id,warehouse', count(*),
                         CAST(coalesce(sum(n), 0) AS BIGINT)
        FROM (SELECT count(*) AS n FROM inventory_snapshots GROUP BY snapshot_date, product_id, warehouse
              HAVING count(*) > 1)
        UNION ALL SELECT 'purchase_orders', 'order_id,line_number', count(*), CAST(coalesce(sum(n), 0) AS BIGINT)
        FROM (SELECT count(*) AS n FROM purchase_orders GROUP BY order_id, line_number HAVING count(*) > 1)"""),
    "j_orphans": O.with_star("""
        SELECT 'purchase_orders->suppliers' AS relationship, count(*) AS orphan_rows FROM purchase_orders po
          WHERE NOT EXISTS (SELECT 1 FROM suppliers s WHERE s.supplier_id = po.supplier_id)
        UNION ALL SELECT 'purchase_orders->products', count(*) FROM purchase_orders po
          WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = po.product_id)
        UNION ALL SELECT 'inventory_snapshots->products', count(*) FROM inventory_snapshots i
          WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = i.product_id)
        UNION ALL SELECT 'products->suppliers', count(*) FROM products p
          WHERE NOT EXISTS (SELECT 1 FROM suppliers s WHERE s.supplier_id = p.supplier_id)"""),
    "j_path_equivalence": O.with_star("""
        SELECT count(*) AS checked_rows,
               count(CASE WHEN p.product_id IS NOT NULL
                          AND l.l_suppkey IS DISTINCT FROM p.supplier_id THEN 1 END) AS mismatches,
               count(CASE WHEN p.product_id IS NULL THEN 1 END) AS unknown_product
        FROM lineitem l LEFT JOIN products p ON l.l_partkey = p.product_id"""),
    "n_status_domain": O.with_star(f"""
        SELECT status, count(*) AS rows FROM purchase_orders
        WHERE status NOT IN {_STATUS_IN} OR status IS NULL GROUP BY status"""),
    "n_warehouse_domain": O.with_star(f"""
        SELECT warehouse, count(*) AS rows FROM inventory_snapshots
        WHERE warehouse NOT IN {_WH_IN} OR warehouse IS NULL GROUP BY warehouse"""),
    "e_domain_checks": O.with_star(f"""
        SELECT 'purchase_orders' AS table_name, c AS "check", CAST(v AS BIGINT) AS violations FROM (
          SELECT count(*) FILTER (WHERE (status IN {_STATUS_IN}) IS NOT TRUE) AS status_not_allowed,
                 count(*) FILTER (WHERE ((status = 'delivered') = (actual_delivery_date IS NOT NULL)) IS NOT TRUE)
                   AS actual_date_iff_delivered,
                 count(*) FILTER (WHERE (quantity > 0) IS NOT TRUE) AS quantity_not_positive,
                 count(*) FILTER (WHERE (unit_cost > 0) IS NOT TRUE) AS unit_cost_not_positive,
                 count(*) FILTER (WHERE (expected_delivery_date >= order_date) IS NOT TRUE) AS expected_before_order
          FROM purchase_orders) UNPIVOT (v FOR c IN (status_not_allowed, actual_date_iff_delivered,
                 quantity_not_positive, unit_cost_not_positive, expected_before_order))
        UNION ALL
        SELECT 'suppliers', c, CAST(v AS BIGINT) FROM (
          SELECT count(*) FILTER (WHERE (reliability_rating BETWEEN 1.0 AND 5.0) IS NOT TRUE) AS rating_out_of_range,
                 count(*) FILTER (WHERE (lead_time_days > 0) IS NOT TRUE) AS lead_time_not_positive,
                 count(*) FILTER (WHERE region IS NULL) AS region_missing
          FROM suppliers) UNPIVOT (v FOR c IN (rating_out_of_range, lead_time_not_positive, region_missing))
        UNION ALL
        SELECT 'inventory_snapshots', c, CAST(v AS BIGINT) FROM (
          SELECT count(*) FILTER (WHERE (warehouse IN {_WH_IN}) IS NOT TRUE) AS warehouse_not_allowed,
                 count(*) FILTER (WHERE (quantity_on_hand >= 0) IS NOT TRUE) AS on_hand_negative,
                 count(*) FILTER (WHERE (quantity_on_order <= 0 OR quantity_on_hand < reorder_point) IS NOT TRUE)
                   AS on_order_while_not_low
          FROM inventory_snapshots) UNPIVOT (v FOR c IN (warehouse_not_allowed, on_hand_negative,
                 on_order_while_not_low))"""),
    "e_setup_verification": O.with_star(f"""
        SELECT a.table_name, a.row_count, e.expected_rows,
               coalesce(a.row_count = e.expected_rows, false) AS matches
        FROM (SELECT 'suppliers' AS table_name, count(*) AS row_count FROM suppliers
              UNION ALL SELECT 'products', count(*) FROM products
              UNION ALL SELECT 'purchase_orders', count(*) FROM purchase_orders
              UNION ALL SELECT 'inventory_snapshots', count(*) FROM inventory_snapshots) a
        FULL JOIN (SELECT 'suppliers' AS table_name, count(*) AS expected_rows FROM supplier
              UNION ALL SELECT 'products', count(*) FROM part
              UNION ALL SELECT 'purchase_orders', count(*) FROM lineitem
              UNION ALL SELECT 'inventory_snapshots', count(*) * {len(WAREHOUSES)} * 17 FROM part) e
        ON a.table_name = e.table_name"""),
    "h_global_filter": O.with_star(f"""
        SELECT region, {O.money(f'sum({O.VALUE})')} AS total_spend FROM pos
        WHERE status != 'cancelled' AND region IN {_in(GLOBAL_PICK)} GROUP BY region"""),
    "h_global_filter_top10": f"SELECT * FROM ({O.ORACLE['top_products_by_spend']}) "
                             f"WHERE region IN {_in(GLOBAL_PICK)}",
    "h_cross_filter": O.with_star(f"""
        SELECT status, count(*) AS order_count,
               {O.money("sum(CASE WHEN status != 'cancelled' THEN po.quantity * po.unit_cost END)")} AS total_spend
        FROM purchase_orders po JOIN suppliers s ON po.supplier_id = s.supplier_id
                                JOIN products p ON po.product_id = p.product_id
        WHERE s.region = '{CROSS_PICK['region']}' GROUP BY status"""),
    "h_counter_filtered": O._counter_sql(COUNTER_PICK),
    "h_date_filter": O.with_star(f"""
        SELECT region, {O.money(f'sum({O.VALUE})')} AS total_spend FROM pos
        WHERE status != 'cancelled' AND order_date >= DATE '{DATE_PICK[0]}-01'
          AND order_date < {O._next_month(DATE_PICK[1])} GROUP BY region"""),
    "h_date_filter_otd": O.with_star(f"""
        SELECT region, {O.rdiv(O.ON_TIME, O.RECEIVED, 3)} AS on_time_pct FROM pos
        WHERE actual_delivery_date IS NOT NULL AND order_date >= DATE '{DATE_PICK[0]}-01'
          AND order_date < {O._next_month(DATE_PICK[1])} GROUP BY region"""),
    "h_top10_refiltered": O.with_star(f"""
        SELECT s.region, p.product_name, p.category, s.supplier_name,
               CAST(sum(po.quantity) AS BIGINT) AS total_quantity,
               {O.money('sum(po.quantity * po.unit_cost)')} AS total_spend
        FROM purchase_orders po JOIN products p ON po.product_id = p.product_id
                                JOIN suppliers s ON po.supplier_id = s.supplier_id
        WHERE po.status != 'cancelled' AND s.region IN {_in(GLOBAL_PICK)}
        GROUP BY s.region, p.product_name, p.category, s.supplier_name
        ORDER BY total_spend DESC, product_name, supplier_name, region, category LIMIT 10"""),
    "h_tidy_wide": O.with_star(f"""
        SELECT {O.MONTH} AS order_month,
               {", ".join(f"CAST(sum(CASE WHEN status = '{s}' THEN 1 END) AS BIGINT) AS {s}" for s in STATUSES)}
        FROM purchase_orders GROUP BY ALL"""),
    "h_format_top_products": f"""
        SELECT *, '$' || format('{{:,.2f}}', total_spend) AS total_spend_display,
               format('{{:,}}', total_quantity) AS total_quantity_display
        FROM ({O.ORACLE['top_products_by_spend']})""",
    "e_diff_results": O.with_star(f"""
        SELECT 'missing' AS side, region, total_spend FROM (
          SELECT region, total_spend FROM t EXCEPT ALL SELECT region, total_spend FROM c)
        UNION ALL
        SELECT 'extra', region, total_spend FROM (
          SELECT region, total_spend FROM c EXCEPT ALL SELECT region, total_spend FROM t)""",
        ctes=f"""t AS ({O.body_of(O.ORACLE['kpi_total_spend'])}),
        c AS (SELECT region, {O.money(f'sum({O.VALUE})')} AS total_spend FROM pos GROUP BY region)"""),
    "e_score_run": B.scores_sql((1,)),
    "e_run_summary": B.summary_sql(),
    "e_compare_runs": B.compare_sql(),
    "e_feedback_summary": B.feedback_sql(),
}


def _alerts_sql() -> str:
    counter = O._counter_sql()
    rules = ", ".join(f"('{m}', '{op}', CAST({t} AS DOUBLE))" for m, op, t in ALERT_RULES)
    return f"""
WITH c AS ({counter}),
v AS (SELECT region, is_total, 'low_stock_count' AS measure, CAST(low_stock_count AS DOUBLE) AS value FROM c
      UNION ALL SELECT region, is_total, 'on_time_pct', CAST(on_time_pct AS DOUBLE) FROM c),
r(measure, op, threshold) AS (VALUES {rules})
SELECT v.measure, v.region, v.is_total, v.value, r.op, r.threshold,
       coalesce(CASE r.op WHEN '>' THEN v.value > r.threshold WHEN '>=' THEN v.value >= r.threshold
                          WHEN '<' THEN v.value < r.threshold WHEN '<=' THEN v.value <= r.threshold
                          WHEN '==' THEN v.value = r.threshold WHEN '!=' THEN v.value != r.threshold END,
                false) AS fired
FROM v JOIN r ON v.measure = r.measure"""


EXTRA_ORACLE["e_alerts"] = _alerts_sql()


def _grain_sql(unit: str) -> str:
    return O.with_star(f"""
        SELECT CAST(date_trunc('{unit}', order_date) AS DATE) AS period, count(*) AS order_count,
               {O.money(f"sum(CASE WHEN status != 'cancelled' THEN {O.VALUE} END)")} AS total_spend
        FROM purchase_orders GROUP BY 1""")


def _margin_sql(by: str) -> str:
    """V1 by one dimension; base one month, compare two: delta is (compare - 2 base) / 2 a month."""
    cents = lambda cond: f"CAST(coalesce(sum(CASE WHEN {cond} THEN {O.VALUE} END), 0) * 100 AS HUGEINT)"
    base = f"order_date >= {O._month(O.BASE_MONTH)} AND order_date < {O._next_month(O.BASE_MONTH)}"
    comp = f"order_date >= {O._month(O.COMPARE_FIRST)} AND order_date < {O._next_month(O.COMPARE_LAST)}"
    return f"""
        SELECT '{by}' AS dimension, member, CAST(b AS DOUBLE) / 100 AS base_spend, CAST(c AS DOUBLE) / 100 AS compare_spend,
               {O.rdiv('(c - 2 * b)', '2', 2, 2)} AS delta_spend,
               {O.rdiv('(c - 2 * b)', '(SELECT sum(c - 2 * b) FROM m_' + by + ')', 4)} AS share_of_change
        FROM m_{by}""", f"""
        m_{by} AS (SELECT {by} AS member, {cents(base)} AS b, {cents(comp)} AS c
                   FROM (SELECT pos.*, p.category FROM pos JOIN products p ON pos.product_id = p.product_id)
                   WHERE status != 'cancelled' AND (({base}) OR ({comp})) GROUP BY 1)"""


def _margins_sql() -> str:
    (a, cte_a), (b, cte_b) = _margin_sql("region"), _margin_sql("category")
    return O.with_star(f"{a} UNION ALL {b}", ctes=f"{cte_a},{cte_b}")


def _totals_sql(where: str, orders_where: str = "true") -> str:
    """The eight datasets' rows and totals under a filter on their output or on the order rows."""
    value = {"kpi_total_orders": "total_orders", "kpi_on_time_rate": "on_time_pct", "kpi_total_spend": "total_spend",
             "kpi_low_stock": "low_stock_count", "spend_by_region": "total_spend", "orders_over_time": "order_count",
             "delivery_by_supplier": "avg_days_variance", "top_products_by_spend": "total_spend"}
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS dataset, count(*) AS rows, CAST(sum(CAST({v} AS DECIMAL(20,3))) AS DOUBLE) AS total
            FROM ({_filtered(O.ORACLE[name], orders_where)}) WHERE {where}"""
        for name, v in value.items())


def _filtered(sql: str, orders_where: str) -> str:
    """The same text over the kept order rows."""
    return sql.replace("  FROM po_1),", f"  FROM po_1 WHERE {orders_where}),")


EXTRA_ORACLE.update({
    "e_review_queue": B.review_queue_sql(),
    "x_orders_by_quarter": _grain_sql("quarter"),
    "x_orders_by_week": _grain_sql("week"),
    "x_spend_driver_margins": _margins_sql(),
    "h_global_filter_all": _totals_sql(f"region IN {_in(GLOBAL_PICK)}"),
    "h_date_filter_all": _totals_sql("true", f"order_date >= DATE '{DATE_PICK[0]}-01' "
                                             f"AND order_date < {O._next_month(DATE_PICK[1])}"),
    "h_format_rates": O.with_star(f"""
        SELECT region, on_time_pct, format('{{:.1f}}%', on_time_pct * 100) AS on_time_pct_display FROM (
          SELECT region, {O.rdiv(O.ON_TIME, O.RECEIVED, 3)} AS on_time_pct FROM pos
          WHERE actual_delivery_date IS NOT NULL GROUP BY region)
        UNION ALL SELECT supplier_name, on_time_pct, format('{{:.1f}}%', on_time_pct) FROM (
          SELECT supplier_name, reliability_rating, {O.rdiv(f'{O.ON_TIME} * 100', O.RECEIVED, 1)} AS on_time_pct
          FROM pos WHERE actual_delivery_date IS NOT NULL GROUP BY supplier_name, reliability_rating)"""),
    "n_synonyms": O.with_star(f"""
        SELECT region, {O.money(f'sum({O.VALUE})')} AS order_value, CAST(max(unit_cost) AS DOUBLE) AS highest_price,
               max(expected_delivery_date) AS last_eta, max(actual_delivery_date) AS last_received,
               {O.rdiv(f'{O.ON_TIME} * 100', O.RECEIVED, 1)} AS otd_rate
        FROM pos GROUP BY region"""),
})
