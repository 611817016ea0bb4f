"""DuckDB oracle texts for the named results (correctness gate).

Each text inlines the conformed star as CTEs over the raw views that the
driver registers (``region nation supplier part orders lineitem``), with the
same integer formulas as ``sources.conform``. Ratios and averages are rounded
HALF_UP (away from zero) in integer arithmetic (``rdiv``), the exact
counterpart of the decimal rounding on the Spark side; money is summed as
DECIMAL and cast to DOUBLE only after rounding.
"""

from __future__ import annotations

from ..sources.conform import (BASE_MONTH, BENCH_REGION, COMPARE_FIRST, COMPARE_LAST,
                               ETA_MONTH, SNAPSHOT_START, SNAPSHOT_WEEKS, WAREHOUSES)


def rdiv(num: str, den: str, digits: int, num_scale: int = 0) -> str:
    """HALF_UP(num / 10^num_scale / den) at ``digits`` as DOUBLE; NULL if den = 0.

    ``num`` and ``den`` are integer-valued SQL expressions.
    """
    shift = digits - num_scale
    n = f"(CAST({num} AS HUGEINT) * {10 ** shift})" if shift >= 0 else None
    if n is None:
        raise ValueError("digits must be >= num_scale")
    d = f"CAST({den} AS HUGEINT)"
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE "
            f"CAST(sign({n}) * sign({d}) * ((abs({n}) * 2 + abs({d})) // (2 * abs({d}))) AS DOUBLE)"
            f" / {10 ** digits} END)")


def cents(expr: str) -> str:
    """Exact integer cents of a 2-dp DECIMAL expression."""
    return f"CAST(({expr}) * 100 AS HUGEINT)"


def money(expr: str) -> str:
    return f"CAST(ROUND({expr}, 2) AS DOUBLE)"


VALUE = "(quantity * unit_cost)"
MONTH = "CAST(date_trunc('month', order_date) AS DATE)"


def _month(m: str) -> str:
    return f"DATE '{m}-01'"


def _next_month(m: str) -> str:
    y, mo = map(int, m.split("-"))
    y, mo = (y + 1, 1) if mo == 12 else (y, mo + 1)
    return f"DATE '{y:04d}-{mo:02d}-01'"


_WH_VALUES = ", ".join(f"({i}, '{w}')" for i, w in enumerate(WAREHOUSES))

STAR = f"""
nsupp AS (SELECT count(*) AS n FROM supplier),
suppliers AS (
  SELECT s.s_suppkey AS supplier_id, s.s_name AS supplier_name, r.r_name AS region,
         n.n_name AS country, CAST(3 + (s.s_suppkey % 28) AS INTEGER) AS lead_time_days,
         CAST(20 + ((s.s_suppkey * 7) % 31) AS DOUBLE) / 10 AS reliability_rating
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey),
products AS (
  SELECT p_partkey AS product_id, p_name || ' #' || CAST(p_partkey AS VARCHAR) AS product_name,
         p_type AS category, CAST(p_retailprice AS DECIMAL(12,2)) AS unit_cost,
         p_partkey % (SELECT n FROM nsupp) AS supplier_id, CAST(p_size AS DOUBLE) AS weight_kg
  FROM part),
po_0 AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, l.l_extendedprice,
         l.l_returnflag, l.l_linestatus, l.l_partkey % (SELECT n FROM nsupp) AS supplier_id,
         CAST(o.o_orderdate AS DATE) AS order_date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
po_1 AS (
  SELECT *, CAST(order_date + CAST(3 + (supplier_id % 28) + ((l_orderkey + l_linenumber) % 8) - 2
                                  AS INTEGER) AS DATE) AS expected_delivery_date,
         CASE WHEN l_linestatus = 'F' THEN 'delivered' WHEN l_returnflag = 'N' THEN 'in_transit'
              WHEN l_returnflag = 'A' THEN 'delayed' WHEN l_returnflag = 'R' THEN 'cancelled' END
           AS status,
         CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * 100 AS BIGINT) AS price_cents,
         CAST(l_quantity AS BIGINT) AS q
  FROM po_0),
purchase_orders AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id, supplier_id,
         order_date, expected_delivery_date,
         CASE WHEN status = 'delivered' THEN CAST(expected_delivery_date
              + CAST(((l_orderkey * 31 + l_linenumber * 17 + l_partkey * 7) % 14) - 3 AS INTEGER)
              AS DATE) END AS actual_delivery_date,
         CAST(l_quantity AS INTEGER) AS quantity,
         CASE WHEN q = 0 THEN NULL ELSE
           CAST(((2 * price_cents + q) // (2 * q)) * 0.01 AS DECIMAL(12,2)) END AS unit_cost,
         status
  FROM po_1),
inventory_snapshots AS (
  SELECT CAST(DATE '{SNAPSHOT_START.isoformat()}' + CAST(t.w * 7 AS INTEGER) AS DATE) AS snapshot_date,
         p.product_id, wh.warehouse,
         CAST((p.product_id * 7919 + wh.wi * 104729 + t.w * 1299709) % 501 AS INTEGER) AS quantity_on_hand,
         CAST(50 + 50 * (p.product_id % 3) AS INTEGER) AS reorder_point,
         CAST(CASE WHEN (p.product_id * 7919 + wh.wi * 104729 + t.w * 1299709) % 501
                        < 50 + 50 * (p.product_id % 3)
                   THEN 50 + 50 * (p.product_id % 3)
                        + (p.product_id * 7919 + wh.wi * 104729 + t.w * 1299709) % 501
                   ELSE 0 END AS INTEGER) AS quantity_on_order
  FROM products p CROSS JOIN (VALUES {_WH_VALUES}) wh(wi, warehouse)
                  CROSS JOIN range(0, {SNAPSHOT_WEEKS}) t(w)),
po AS (SELECT * FROM purchase_orders),
pos AS (SELECT po.*, s.supplier_name, s.region, s.country, s.lead_time_days, s.reliability_rating
        FROM purchase_orders po JOIN suppliers s ON po.supplier_id = s.supplier_id),
latest_inv AS (SELECT * FROM inventory_snapshots
               WHERE snapshot_date = (SELECT max(snapshot_date) FROM inventory_snapshots)),
inv_ps AS (SELECT i.*, p.product_name, p.category, s.region, s.supplier_name
           FROM latest_inv i JOIN products p ON i.product_id = p.product_id
                             JOIN suppliers s ON p.supplier_id = s.supplier_id)
"""


def with_star(body: str, ctes: str = "") -> str:
    extra = f",\n{ctes}" if ctes else ""
    return f"WITH {STAR.strip()}{extra}\n{body.strip()}"


def body_of(sql: str) -> str:
    """The final SELECT of a ``with_star`` text that has no extra CTEs."""
    prefix = f"WITH {STAR.strip()}\n"
    if not sql.startswith(prefix):
        raise ValueError("not a plain with_star text")
    return sql[len(prefix):]


ON_TIME = "count(CASE WHEN actual_delivery_date <= expected_delivery_date THEN 1 END)"
RECEIVED = "count(actual_delivery_date)"
VAR = "datediff('day', expected_delivery_date, actual_delivery_date)"


def _on_time_pct(scale=100, digits=1):
    return rdiv(f"{ON_TIME} * {scale}", RECEIVED, digits)


ORACLE = {
    "row_counts": with_star("""
        SELECT 'suppliers' AS table_name, count(*) AS row_count FROM suppliers
        UNION ALL SELECT 'products', count(*) FROM products
        UNION ALL SELECT 'purchase_orders', count(*) FROM purchase_orders
        UNION ALL SELECT 'inventory_snapshots', count(*) FROM inventory_snapshots"""),
    "suppliers_directory": with_star("SELECT * FROM suppliers ORDER BY region, supplier_name"),
    "product_category_stats": with_star(f"""
        SELECT category, count(*) AS product_count,
               {rdiv(cents('sum(unit_cost)'), 'count(unit_cost)', 2, 2)} AS avg_unit_cost,
               CAST(min(unit_cost) AS DOUBLE) AS min_cost, CAST(max(unit_cost) AS DOUBLE) AS max_cost
        FROM products GROUP BY category ORDER BY category"""),
    "order_status_distribution": with_star(f"""
        SELECT status, count(*) AS order_count,
               {rdiv('sum(quantity)', 'count(quantity)', 0)} AS avg_quantity,
               {money(f'sum({VALUE})')} AS total_spend
        FROM purchase_orders GROUP BY status ORDER BY order_count DESC"""),
    "late_deliveries_by_region": with_star(f"""
        SELECT region, count(*) AS delayed_orders, {rdiv(f'sum({VAR})', 'count(*)', 1)} AS avg_days_late
        FROM pos WHERE status = 'delivered' AND actual_delivery_date > expected_delivery_date
        GROUP BY region ORDER BY delayed_orders DESC"""),
    "kpi_total_orders": with_star("SELECT region, count(*) AS total_orders FROM pos GROUP BY region"),
    "kpi_on_time_rate": with_star(f"""
        SELECT region, {_on_time_pct(1, 3)} AS on_time_pct FROM pos
        WHERE actual_delivery_date IS NOT NULL GROUP BY region"""),
    "kpi_total_spend": with_star(f"""
        SELECT region, {money(f'sum({VALUE})')} AS total_spend FROM pos
        WHERE status != 'cancelled' GROUP BY region"""),
    "kpi_low_stock": with_star("""
        SELECT region, count(*) AS low_stock_count FROM inv_ps
        WHERE quantity_on_hand < reorder_point GROUP BY region"""),
    "spend_by_region": with_star(f"""
        SELECT region, {money(f'sum({VALUE})')} AS total_spend FROM pos
        WHERE status != 'cancelled' GROUP BY region ORDER BY total_spend DESC"""),
    "orders_over_time": with_star(f"""
        SELECT region, {MONTH} AS order_month, status, count(*) AS order_count
        FROM pos GROUP BY ALL ORDER BY order_month, status"""),
    "delivery_by_supplier": with_star(f"""
        SELECT region, supplier_name, {rdiv(f'sum({VAR})', 'count(*)', 1)} AS avg_days_variance
        FROM pos WHERE actual_delivery_date IS NOT NULL GROUP BY region, supplier_name
        ORDER BY avg_days_variance"""),
    "top_products_by_spend": with_star(f"""
        SELECT s.region, p.product_name, p.category, s.supplier_name,
               CAST(sum(po.quantity) AS BIGINT) AS total_quantity,
               {money(f'sum(po.quantity * po.unit_cost)')} AS total_spend
        FROM purchase_orders po JOIN products p ON po.product_id = p.product_id
                                JOIN suppliers s ON po.supplier_id = s.supplier_id
        WHERE po.status != 'cancelled'
        GROUP BY s.region, p.product_name, p.category, s.supplier_name
        ORDER BY total_spend DESC, product_name, supplier_name, region, category LIMIT 10"""),
    "monthly_orders_by_status": with_star(f"""
        SELECT {MONTH} AS order_month, status, count(*) AS order_count
        FROM purchase_orders GROUP BY ALL ORDER BY order_month, status"""),
    "bm_suppliers_in_region": with_star(
        f"SELECT count(*) AS supplier_count FROM suppliers WHERE region = '{BENCH_REGION}'"),
    "bm_avg_order_value": with_star(f"""
        SELECT {rdiv(cents(f'sum({VALUE})'), 'count(*)', 2, 2)} AS avg_order_value
        FROM purchase_orders WHERE status != 'cancelled'"""),
    "bm_worst_warehouse": with_star("""
        SELECT i.warehouse, count(*) AS low_stock_items
        FROM latest_inv i JOIN products p ON i.product_id = p.product_id
        WHERE i.quantity_on_hand < i.reorder_point
        GROUP BY i.warehouse ORDER BY low_stock_items DESC, warehouse LIMIT 1"""),
    "bm_monthly_spend": with_star(f"""
        SELECT {MONTH} AS order_month, {money(f'sum({VALUE})')} AS monthly_spend
        FROM purchase_orders WHERE status != 'cancelled' GROUP BY ALL ORDER BY order_month"""),
    "bm_best_suppliers": with_star(f"""
        SELECT supplier_name, reliability_rating, {_on_time_pct()} AS on_time_pct
        FROM pos WHERE actual_delivery_date IS NOT NULL
        GROUP BY supplier_name, reliability_rating
        ORDER BY on_time_pct DESC, reliability_rating DESC"""),
    "q_order_count": with_star("SELECT count(*) AS order_count FROM purchase_orders"),
    "q_overall_on_time": with_star(f"""
        SELECT {_on_time_pct()} AS on_time_delivery_rate FROM purchase_orders
        WHERE actual_delivery_date IS NOT NULL"""),
    "q_most_delayed_supplier": with_star("""
        SELECT supplier_name, count(*) AS delayed_orders FROM pos WHERE status = 'delayed'
        GROUP BY supplier_name ORDER BY delayed_orders DESC, supplier_name LIMIT 1"""),
    "q_monthly_spend_by_category": with_star(f"""
        SELECT {MONTH} AS order_month, p.category, {money('sum(po.quantity * po.unit_cost)')} AS total_spend
        FROM purchase_orders po JOIN products p ON po.product_id = p.product_id
        WHERE po.status != 'cancelled' GROUP BY ALL"""),
    "q_below_reorder_now": with_star("""
        SELECT i.snapshot_date, i.product_id, p.product_name, i.warehouse, i.quantity_on_hand,
               i.reorder_point, i.quantity_on_order
        FROM latest_inv i JOIN products p ON i.product_id = p.product_id
        WHERE i.quantity_on_hand < i.reorder_point"""),
    "q_region_lead_vs_delivery": with_star(f"""
        SELECT c.region, c.avg_contracted_lead_days, d.avg_actual_lead_days, d.on_time_pct,
               d.avg_days_variance
        FROM (SELECT region, {rdiv('sum(lead_time_days)', 'count(lead_time_days)', 1)}
                     AS avg_contracted_lead_days FROM suppliers GROUP BY region) c
        LEFT JOIN (
          SELECT region,
                 {rdiv("sum(datediff('day', order_date, actual_delivery_date))", RECEIVED, 1)}
                   AS avg_actual_lead_days,
                 {_on_time_pct()} AS on_time_pct,
                 {rdiv(f'sum({VAR})', RECEIVED, 1)} AS avg_days_variance
          FROM pos WHERE actual_delivery_date IS NOT NULL GROUP BY region) d
        ON c.region = d.region"""),
    "q_top_spend_region": with_star(f"""
        SELECT region, {money(f'sum({VALUE})')} AS total_spend FROM pos
        WHERE status != 'cancelled' GROUP BY region ORDER BY total_spend DESC, region LIMIT 1"""),
    "q_worst_suppliers": with_star(f"""
        SELECT supplier_name, {_on_time_pct()} AS on_time_pct,
               {rdiv(f'sum({VAR})', RECEIVED, 1)} AS avg_days_variance
        FROM pos WHERE actual_delivery_date IS NOT NULL GROUP BY supplier_name"""),
    "q_order_value_by_eta_month": with_star(f"""
        SELECT {money(f'sum({VALUE})')} AS order_value FROM purchase_orders
        WHERE expected_delivery_date >= {_month(ETA_MONTH)}
          AND expected_delivery_date < {_next_month(ETA_MONTH)}"""),
    "q_warehouse_low_stock_all": with_star(f"""
        SELECT w.warehouse, coalesce(x.n, 0) AS low_stock_count
        FROM (VALUES {", ".join(f"('{w}')" for w in WAREHOUSES)}) w(warehouse)
        LEFT JOIN (SELECT warehouse, count(*) AS n FROM latest_inv
                   WHERE quantity_on_hand < reorder_point GROUP BY warehouse) x
        ON w.warehouse = x.warehouse"""),
}


def _drivers_sql() -> str:
    base = f"order_date >= {_month(BASE_MONTH)} AND order_date < {_next_month(BASE_MONTH)}"
    cmp_ = f"order_date >= {_month(COMPARE_FIRST)} AND order_date < {_next_month(COMPARE_LAST)}"
    y0, m0 = map(int, COMPARE_FIRST.split("-"))
    y1, m1 = map(int, COMPARE_LAST.split("-"))
    cm = (y1 - y0) * 12 + (m1 - m0) + 1
    return with_star(f"""
        SELECT region, category, {money('b')} AS base_spend, {money('c')} AS compare_spend,
               {rdiv(cents('d'), str(cm), 2, 2)} AS delta_spend,
               {rdiv(cents('d'), cents('(SELECT sum(d) FROM dd)'), 4)} AS share_of_change
        FROM dd ORDER BY delta_spend DESC, region, category""", ctes=f"""
        agg AS (
          SELECT s.region, p.category,
                 coalesce(sum(CASE WHEN {base} THEN po.quantity * po.unit_cost END), 0) AS b,
                 coalesce(sum(CASE WHEN {cmp_} THEN po.quantity * po.unit_cost END), 0) AS c,
                 count(CASE WHEN {base} THEN 1 END) + count(CASE WHEN {cmp_} THEN 1 END) AS n
          FROM purchase_orders po JOIN suppliers s ON po.supplier_id = s.supplier_id
                                  JOIN products p ON po.product_id = p.product_id
          WHERE po.status != 'cancelled' GROUP BY s.region, p.category),
        dd AS (SELECT region, category, b, c, c * 1 - b * {cm} AS d FROM agg WHERE n > 0)""")


def _mom_sql() -> str:
    return with_star(f"""
        SELECT a.order_month, {money('a.s')} AS monthly_spend, {money('b.s')} AS prev_monthly_spend,
               {money('a.s - b.s')} AS mom_change,
               {rdiv(cents('(a.s - b.s) * 100'), cents('b.s'), 1)} AS mom_pct
        FROM m a LEFT JOIN m b ON a.order_month = CAST(b.order_month + INTERVAL 1 MONTH AS DATE)
        ORDER BY a.order_month""", ctes=f"""
        m AS (SELECT {MONTH} AS order_month, sum({VALUE}) AS s FROM purchase_orders
              WHERE status != 'cancelled' GROUP BY ALL)""")


def _counter_sql(values=None) -> str:
    filt = ""
    if values:
        lst = ", ".join(f"'{v}'" for v in values)
        filt = f"WHERE region IN ({lst})"
    return with_star(f"""
        SELECT coalesce(o.region, s.region) AS region, coalesce(o.is_total, s.is_total) AS is_total,
               coalesce(o.total_orders, 0) AS total_orders, o.on_time_pct, o.total_spend,
               coalesce(s.low_stock_count, 0) AS low_stock_count
        FROM o FULL JOIN s ON o.region IS NOT DISTINCT FROM s.region AND o.is_total = s.is_total""",
        ctes=f"""
        o AS (SELECT region, grouping(region) > 0 AS is_total, count(*) AS total_orders,
                     {rdiv(f'count(CASE WHEN actual_delivery_date IS NOT NULL AND actual_delivery_date <= expected_delivery_date THEN 1 END)', 'count(actual_delivery_date)', 3)} AS on_time_pct,
                     {money(f"sum(CASE WHEN status != 'cancelled' THEN {VALUE} END)")} AS total_spend
              FROM pos {filt} GROUP BY GROUPING SETS ((region), ())),
        s AS (SELECT region, grouping(region) > 0 AS is_total, count(*) AS low_stock_count
              FROM inv_ps WHERE quantity_on_hand < reorder_point
              {('AND ' + filt[6:]) if filt else ''}
              GROUP BY GROUPING SETS ((region), ()))""")


def _volume_price_sql() -> str:
    base = f"order_date >= {_month(BASE_MONTH)} AND order_date < {_next_month(BASE_MONTH)}"
    cmp_ = f"order_date >= {_month(COMPARE_FIRST)} AND order_date < {_next_month(COMPARE_LAST)}"
    return with_star(f"""
        SELECT a.product_id, p.product_name, p.category, {money('sb')} AS base_spend,
               {money('sc')} AS compare_spend,
               CASE WHEN qb = 0 THEN {money('sc')}
                    ELSE {rdiv(cents('sb') + ' * (qc - qb)', 'qb', 2, 2)} END AS volume_effect,
               CASE WHEN qb = 0 THEN {money('sc - sc')}
                    ELSE {rdiv(f"({cents('sc - sb')}) * qb - {cents('sb')} * (qc - qb)", 'qb', 2, 2)} END
                 AS price_effect
        FROM (SELECT product_id,
                     coalesce(sum(CASE WHEN {base} THEN {VALUE} END), 0) AS sb,
                     coalesce(sum(CASE WHEN {cmp_} THEN {VALUE} END), 0) AS sc,
                     coalesce(sum(CASE WHEN {base} THEN quantity END), 0) AS qb,
                     coalesce(sum(CASE WHEN {cmp_} THEN quantity END), 0) AS qc
              FROM purchase_orders WHERE status != 'cancelled' AND ({base} OR {cmp_})
              GROUP BY product_id) a
        JOIN products p ON a.product_id = p.product_id""")


ORACLE["bm_best_suppliers_all"] = with_star(f"""
    SELECT n.supplier_name, n.reliability_rating, r.on_time_pct
    FROM (SELECT DISTINCT supplier_name, reliability_rating FROM suppliers) n
    LEFT JOIN (SELECT supplier_name, reliability_rating, {_on_time_pct()} AS on_time_pct
               FROM pos WHERE actual_delivery_date IS NOT NULL
               GROUP BY supplier_name, reliability_rating) r
      ON n.supplier_name = r.supplier_name AND n.reliability_rating = r.reliability_rating""")
ORACLE["q_spend_drivers"] = _drivers_sql()
ORACLE["x_spend_volume_price"] = _volume_price_sql()
ORACLE["q_region_lead_weighted"] = with_star(f"""
    SELECT region, {rdiv('sum(lead_time_days)', 'count(lead_time_days)', 1)} AS avg_contracted_lead_days
    FROM pos GROUP BY region""")
ORACLE["x_spend_mom_change"] = _mom_sql()
ORACLE["x_counter_all_regions"] = _counter_sql()
