"""Registered queries over the run ledger, ranks, running totals, sketches, versions and tolerant matching."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import drift as K
from ..operators import ledger as L
from ..operators import metrics as M
from ..operators import ordered as S
from ..operators import tolerance as T
from ..operators.enrich import ORDER_DIMS
from ..session import scratch_path
from ..sources import catalog as C
from ..sources.conform import load_star, status_of
from ..sources.raw import Raw
from . import benchmark as B
from . import oracle as O
from .results import RESULTS, spend_driver_cube

# fixed values: the region of the reduced fact, the tolerance of unit prices, and which lines are off by far.
REDUCED_REGION = "EUROPE"
PRICE_TOLERANCE = 0.0051
OFF_EVERY, OFF_BY = 1000, 1_000_000
REVIEW_DAYS = 7


def x_spend_driver_cube(spark, sf_dir) -> DataFrame:
    """The change in spend by region and category, by each alone, and in total."""
    return spend_driver_cube(load_star(spark, sf_dir))


def w_product_spend_ranks(spark, sf_dir) -> DataFrame:
    """Every product's spend with its dense rank."""
    spend = M.metrics(load_star(spark, sf_dir).purchase_orders, [M.total_spend()], ["product_id"])
    return S.dense_rank(spend, [("total_spend", True)], "spend_rank")


def w_supplier_ranks(spark, sf_dir) -> DataFrame:
    """Suppliers with their rank by on-time rate, then rating; equal ones share a rank."""
    best = RESULTS["bm_best_suppliers"](load_star(spark, sf_dir))
    return S.dense_rank(best, [("on_time_pct", True), ("reliability_rating", True)], "supplier_rank")


def j_reduced_spend(spark, sf_dir) -> DataFrame:
    """Spend by category of one region's suppliers; the order lines of other suppliers go before they are summed."""
    star = load_star(spark, sf_dir)
    return M.star_metrics(star, star.purchase_orders, ORDER_DIMS, [M.total_spend(), M.order_count()], ["category"],
                          dim_where={"suppliers": F.col("region") == REDUCED_REGION}, strategy="eager")


def a_replace_table(spark, sf_dir) -> DataFrame:
    """A described table replaced by a version with other rows and columns, read by its name."""
    ns = C.Namespace(schema=f"qm_{uuid.uuid4().hex[:10]}")
    suppliers = load_star(spark, sf_dir).suppliers
    C.replace_table(suppliers.select("supplier_id", "region").where("supplier_id % 2 = 0"), ns, "suppliers")
    C.replace_table(suppliers, ns, "suppliers", C.TABLE_COMMENTS["suppliers"], C.COLUMN_COMMENTS["suppliers"])
    return spark.table(ns.fq("suppliers"))


def q_open_orders_by_day(spark, sf_dir) -> DataFrame:
    """E5: order lines placed, received and open at the end of each day; cancelled lines never open."""
    orders = load_star(spark, sf_dir).purchase_orders.where(M.NOT_CANCELLED())
    return S.backlog(orders.select(F.col("order_date").alias("day")),
                     orders.select(F.col("actual_delivery_date").alias("day")))


def e_review_backlog(spark, sf_dir) -> DataFrame:
    """E5: thumbs-down answers that wait for review, by day; a review comes a week after the question."""
    down = B.feedback_frame(B.scored_runs(load_star(spark, sf_dir), (1, 2))).where("verdict = 'down'")
    return S.backlog(down.select(F.col("asked_at").alias("day")),
                     down.where("reviewed").select(F.date_add("asked_at", REVIEW_DAYS).alias("day")))


def e_drift_by_month(spark, sf_dir) -> DataFrame:
    """How the distributions of quantity, unit price and lead days move from month to month."""
    orders = load_star(spark, sf_dir).purchase_orders.withColumn("lead_days", F.datediff("expected_delivery_date", "order_date"))
    return K.drift(K.sketches(orders, X.month_start("order_date"), ["quantity", "unit_cost", "lead_days"]))


def e_diff_within(spark, sf_dir) -> DataFrame:
    """The stored unit prices against the unrounded ones, within half a cent; some lines are off by far."""
    raw = Raw(spark, sf_dir)
    truth = load_star(spark, sf_dir).purchase_orders.select("status", F.col("unit_cost").cast("double").alias("price"))
    lines = raw.lineitem.join(raw.orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    price = F.try_divide("l_extendedprice", "l_quantity") + F.when(F.col("l_orderkey") % OFF_EVERY == 0, OFF_BY).otherwise(0)
    candidate = lines.select(status_of(F.col("l_linestatus"), F.col("l_returnflag")).alias("status"), price.alias("price"))
    found = T.diff_within(truth, candidate, "price", PRICE_TOLERANCE)
    return found.groupBy("side", "status").agg(F.sum("n").alias("lines"))


def asked(star, run_id: int, correct: set[str] = frozenset()) -> list[L.Asked]:
    """Run 1 asks the untuned way; later runs answer anew whatever wasn't ``correct``."""
    if run_id > 1:
        B.sqlfuncs.register(star.spark, star)
    out = []
    for q in B.QUESTIONS:
        tuned = run_id > 1 and q.question not in correct
        out.append(L.Asked(
            q.question, q.category, q.tuned if tuned else q.untuned_sql,
            lambda q=q, tuned=tuned: (RESULTS[q.truth_key](star), star.spark.sql(q.tuned) if tuned else q.untuned(star)),
            q.keys))
    return out


def e_run_history(spark, sf_dir) -> DataFrame:
    """Three runs in the ledger; the second asks again what failed, the third has nothing to ask."""
    star, path = load_star(spark, sf_dir), scratch_path(spark, f"ledger/{uuid.uuid4().hex}")
    state = star.path or sf_dir
    first = L.record(spark, path, 1, asked(star, 1), state)
    correct = {r.question for r in first.where("score = 'Correct'").select("question").collect()}
    for run_id in (2, 3):
        L.record(spark, path, run_id, asked(star, run_id, correct), state)
    return L.history(L.read(spark, path))


OPERATION_QUERIES = {f.__name__: f for f in (
    x_spend_driver_cube, w_product_spend_ranks, w_supplier_ranks, j_reduced_spend, a_replace_table, q_open_orders_by_day,
    e_review_backlog, e_drift_by_month, e_diff_within, e_run_history)}


def _cube_sql() -> str:
    cents = lambda cond: f"CAST(coalesce(sum(CASE WHEN {cond} THEN {O.VALUE} END), 0) * 100 AS HUGEINT)"
    base = f"order_date >= {O._month(O.BASE_MONTH)} AND order_date < {O._next_month(O.BASE_MONTH)}"
    comp = f"order_date >= {O._month(O.COMPARE_FIRST)} AND order_date < {O._next_month(O.COMPARE_LAST)}"
    return O.with_star(f"""
        SELECT concat_ws(',', CASE WHEN gr = 0 THEN 'region' END, CASE WHEN gc = 0 THEN 'category' END) AS grouped_by,
               region, category, CAST(b AS DOUBLE) / 100 AS base_spend, CAST(c AS DOUBLE) / 100 AS compare_spend,
               {O.rdiv('(c - 2 * b)', '2', 2, 2)} AS delta_spend,
               {O.rdiv('(c - 2 * b)', '(SELECT c - 2 * b FROM cube WHERE gr = 1 AND gc = 1)', 4)} AS share_of_change
        FROM cube""", ctes=f"""
        cube AS (SELECT region, category, grouping(region) AS gr, grouping(category) AS gc, {cents(base)} AS b, {cents(comp)} AS c
                 FROM (SELECT pos.*, p.category FROM pos JOIN products p ON pos.product_id = p.product_id)
                 WHERE status != 'cancelled' AND (({base}) OR ({comp}))
                 GROUP BY GROUPING SETS ((region, category), (region), (category), ()))""")


def _backlog_sql(opened: str, closed: str) -> str:
    return f"""
        SELECT day, CAST(sum(o) AS BIGINT) AS opened, CAST(sum(c) AS BIGINT) AS closed,
               CAST(sum(sum(o) - sum(c)) OVER (ORDER BY day) AS BIGINT) AS open
        FROM (SELECT day, 1 AS o, 0 AS c FROM ({opened}) UNION ALL SELECT day, 0, 1 FROM ({closed}))
        WHERE day IS NOT NULL GROUP BY day"""


def _history_sql() -> str:
    return f"""
WITH runs AS ({B.scores_sql((1, 2))}),
second AS (
  SELECT b.question, b.category, a.score = 'Correct' AS kept,
         CASE WHEN a.score = 'Correct' THEN a.score ELSE b.score END AS score
  FROM runs a JOIN runs b ON a.question = b.question AND a.run_id = 1 AND b.run_id = 2)
SELECT 1 AS run_id, question, category, score, false AS carried, 1 AS scored_in FROM runs WHERE run_id = 1
UNION ALL SELECT 2, question, category, score, kept, CASE WHEN kept THEN 1 ELSE 2 END FROM second
UNION ALL SELECT 3, question, category, score, score = 'Correct',
                 CASE WHEN score <> 'Correct' THEN 3 WHEN kept THEN 1 ELSE 2 END FROM second"""


OPERATION_ORACLE = {
    "x_spend_driver_cube": _cube_sql(),
    "w_product_spend_ranks": O.with_star(f"""
        SELECT product_id, total_spend, dense_rank() OVER (ORDER BY total_spend DESC NULLS LAST) AS spend_rank
        FROM (SELECT product_id, {O.money(f'sum({O.VALUE})')} AS total_spend FROM purchase_orders
              WHERE status != 'cancelled' GROUP BY product_id)"""),
    "w_supplier_ranks": O.with_star(f"""
        SELECT *, dense_rank() OVER (ORDER BY on_time_pct DESC NULLS LAST, reliability_rating DESC NULLS LAST) AS supplier_rank
        FROM ({O.body_of(O.ORACLE['bm_best_suppliers'])})"""),
    "j_reduced_spend": O.with_star(f"""
        SELECT p.category, {O.money(f"sum(CASE WHEN status != 'cancelled' THEN pos.quantity * pos.unit_cost END)")} AS total_spend,
               count(*) AS order_count
        FROM pos JOIN products p ON pos.product_id = p.product_id WHERE region = '{REDUCED_REGION}' GROUP BY p.category"""),
    "a_replace_table": O.with_star("SELECT * FROM suppliers"),
    "q_open_orders_by_day": O.with_star(_backlog_sql(
        "SELECT order_date AS day FROM purchase_orders WHERE status != 'cancelled'",
        "SELECT actual_delivery_date AS day FROM purchase_orders WHERE status != 'cancelled'")),
    "e_review_backlog": f"WITH runs AS ({B.scores_sql((1, 2))})" + _backlog_sql(
        f"SELECT CASE run_id WHEN 1 THEN DATE '{B.RUN_DATES[1]}' ELSE DATE '{B.RUN_DATES[2]}' END AS day FROM runs WHERE score != 'Correct'",
        f"SELECT CAST(DATE '{B.RUN_DATES[1]}' + {REVIEW_DAYS} AS DATE) AS day FROM runs WHERE score != 'Correct' AND run_id = 1"),
    "e_diff_within": O.with_star(f"""
        SELECT side, status, CAST(count(*) AS BIGINT) AS lines
        FROM purchase_orders, (VALUES ('missing'), ('extra')) s(side) WHERE order_id % {OFF_EVERY} = 0 GROUP BY ALL"""),
    "e_run_history": _history_sql(),
}
