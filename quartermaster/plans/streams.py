"""Registered streaming queries: run the stream to completion, read its sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import metrics as M
from ..operators.enrich import ORDER_DIMS, supplier_dim
from ..session import open_files, path_exists, publish
from ..sources.conform import load_star, n_suppliers, order_lines
from ..sources.raw import Raw
from ..streaming import event_time as T
from ..streaming import refresh as R
from ..streaming.retract import Refresh
from ..streaming import upsert as U
from . import oracle as O

# fixed values: the on-time floor checked on every refreshed KPI batch.
STREAM_ALERT_RULES = (("on_time_pct", "<", 0.3),)


def _refreshed(spark, sf_dir, kind: str, on_batch=None) -> str:
    """Run the KPI refresh over the order files; the run's folder."""
    star, run = load_star(spark, sf_dir), R.new_run_dir(spark, kind)
    R.refresh_stream(R.order_stream(spark, sf_dir, run), supplier_dim(star), f"{run}/out", f"{run}/ckpt",
                     on_batch=on_batch(run) if on_batch else None,
                     small_dim=star.small("suppliers")).awaitTermination()
    return run


def r_refresh_kpi(spark, sf_dir) -> DataFrame:
    """Region KPIs maintained by the order stream (equals the batch values)."""
    return spark.read.parquet(f"{_refreshed(spark, sf_dir, 'kpi')}/out")


def _daily(spark, sf_dir) -> DataFrame:
    run = R.new_run_dir(spark, "daily")
    R.run_daily_counts(R.order_stream(spark, sf_dir, run), f"{run}/out", f"{run}/ckpt").awaitTermination()
    return spark.read.parquet(f"{run}/out")


def r_daily_counts(spark, sf_dir) -> DataFrame:
    """R2: order counts of every day and status, the last seven days marked as open."""
    return R.mark_open(_daily(spark, sf_dir))


def r_refresh_upsert(spark, sf_dir) -> DataFrame:
    """R1 with changing orders: two feeds of order-line versions (before and
    after delivery) in an append-only log; the KPIs of its newest versions equal
    the batch values on the final star."""
    star = load_star(spark, sf_dir)
    return U.run_two_feeds(spark, star.purchase_orders, supplier_dim(star), R.new_run_dir(spark, "upsert"),
                           small_dim=star.small("suppliers"))


def r_monthly_counts(spark, sf_dir) -> DataFrame:
    """R2: the streamed daily counts rolled up to months in batch."""
    return R.rollup_daily_to_month(_daily(spark, sf_dir))


def r_alert_stream(spark, sf_dir) -> DataFrame:
    """On-time alerts that stand after the last refresh of the KPI stream."""
    rules = spark.createDataFrame(list(STREAM_ALERT_RULES), "measure string, op string, threshold double")
    run = _refreshed(spark, sf_dir, "alerts", lambda run: R.alert_sink(rules, f"{run}/alerts"))
    return R.read_alerts(spark, f"{run}/alerts", latest=True).drop("epoch")


# fixed values: how long the watermark waits, and how long lines and headers wait for each other.
DELAY_DAYS = 30
FEED_DELAY, FEED_BOUND, FEED_HOURS = "24 hours", "48 hours", 300


def run_event_time(spark, orders: DataFrame, run: str, months: int = 12, days: int = DELAY_DAYS):
    """Order lines in order of arrival, ``months`` at a time, through the router and the day counts.

    (counts per day, status; the queries that ran)
    """
    day = T.arrival_date(F.col("order_date"))
    fed = orders.withColumn("period", F.floor((F.year(day) * 12 + F.month(day) - 1) / months))
    periods = sorted(r.period for r in fed.select("period").distinct().collect())
    schema = orders.schema
    counted = T.replay(
        spark, periods,
        lambda p: T.land(spark, fed.where(F.col("period") == p).drop("period"), f"{run}/feed", p),
        [lambda: T.split_late(spark.readStream.schema(schema).parquet(f"{run}/feed/period=*"), "order_date",
                              f"{days} days", f"{run}/routed", f"{run}/ckpt-route"),
         lambda: T.closed_days(T.on_time_stream(spark, schema, f"{run}/routed"), "order_date", f"{days} days",
                               f"{run}/closed", f"{run}/ckpt-days")])
    return T.event_counts(spark, schema, "order_date", f"{run}/routed", f"{run}/closed"), counted


def r_event_time_counts(spark, sf_dir) -> DataFrame:
    """R2 in event time: lines counted on time and late per day and status, days closed by the watermark."""
    orders = load_star(spark, sf_dir).purchase_orders.select("order_id", "line_number", "product_id", "order_date", "status")
    return run_event_time(spark, orders, R.new_run_dir(spark, "event-time"))[0]


LINE_TIME, HEADER_TIME = "line_at", "header_at"


def run_two_streams(spark, sf_dir: str, run: str, order=sorted, hours: int = FEED_HOURS):
    """Headers and lines in feeds of their own, landed in periods of arrival in ``order``.

    (order lines with their headers; lines that met their header in the stream, all lines left over)
    """
    raw = Raw(spark, sf_dir)
    line_hour, header_hour = T.line_hour("l_orderkey", "l_linenumber", "l_partkey"), T.header_hour("o_orderkey")
    lines = raw.lineitem.withColumn(LINE_TIME, T.at_hour(line_hour)).withColumn("period", F.floor(line_hour / hours))
    headers = (raw.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
               .withColumn(HEADER_TIME, T.at_hour(header_hour)).withColumn("period", F.floor(header_hour / hours)))
    feeds = {"lines": lines, "headers": headers}
    schemas = {k: f.drop("period").schema for k, f in feeds.items()}
    periods = order(r.period for r in lines.select("period").union(headers.select("period")).distinct().collect())
    # two heartbeats after all else: the first moves the watermark, the second's batch gives up what still waits
    beats = [max(periods, default=0) + 1, max(periods, default=0) + 2]

    def land(p) -> None:
        for k, f in feeds.items():
            if p in beats:
                # the join drops headers without a key before it sees their time; no order has this one
                fixed = {LINE_TIME: "2100-01-01", HEADER_TIME: "2100-01-01", "o_orderkey": -2**63}
                f = spark.range(1).select(*[F.lit(fixed.get(c.name)).cast(c.dataType).alias(c.name) for c in schemas[k].fields])
            else:
                f = f.where(F.col("period") == p).drop("period")
            T.land(spark, f, f"{run}/{k}", p)

    feed = lambda k: spark.readStream.schema(schemas[k]).parquet(f"{run}/{k}/period=*")
    T.replay(spark, [*periods, *beats], land, [
        lambda: T.split_late(feed("lines"), LINE_TIME, FEED_DELAY, f"{run}/routed", f"{run}/ckpt-route",
                             at_mark=True),
        lambda: T.join_feeds(T.on_time_stream(spark, schemas["lines"], f"{run}/routed"), feed("headers"), "l_orderkey",
                             "o_orderkey", LINE_TIME, HEADER_TIME, FEED_DELAY, FEED_BOUND, f"{run}/joined",
                             f"{run}/ckpt-join")])
    joined = spark.read.schema(StructType(schemas["lines"].fields + schemas["headers"].fields)).parquet(f"{run}/joined/epoch=*")
    late = T.routed(spark, schemas["lines"], f"{run}/routed", late=True)
    columns = [c for c in schemas["lines"].names if c != LINE_TIME]
    rows = T.reconciled(joined, late, headers, "l_orderkey", "o_orderkey", columns, ["o_orderkey", "order_date"])
    return order_lines(rows, n_suppliers(raw)), joined, late


def r_two_feeds(spark, sf_dir) -> DataFrame:
    """R1 over two feeds: region KPIs of lines that met their header in the stream or by the batch lookup."""
    star = load_star(spark, sf_dir)
    rows = run_two_streams(spark, sf_dir, R.new_run_dir(spark, "two-feeds"))[0]
    return M.star_metrics(star, rows, ORDER_DIMS, R.kpi_measures(), ["region"], keep_empty=True)


def run_retraction(spark, star, run: str, measures=None, triggers: int = 3, buckets: int = 32) -> Refresh:
    """Versions before delivery in one trigger, then the final ones in ``triggers`` more."""
    numbered = U.with_occurrence(star.purchase_orders)
    schema = U.order_versions(numbered)[0].schema
    # numbered once, all feeds in one write: each lands when its turn comes
    turn = F.pmod(F.col("order_id"), F.lit(triggers)) + 1
    first = F.lit(0).cast(numbered.select(turn.alias("turn")).schema["turn"].dataType)
    rows = numbered.withColumn("turn", F.explode(F.when(U.delivered(), F.array(first, turn)).otherwise(F.array(first))))
    before = U.before_delivery(numbered)
    feeds = rows.select(*[F.when(F.col("turn") == 0, before[c]).otherwise(F.col(c)).alias(c) for c in numbered.columns],
                        F.when(F.col("turn") == 0, 1).otherwise(2).alias("version"), "turn")
    with open_files(spark, triggers + 2):
        feeds.write.mode("overwrite").option("compression", "zstd").partitionBy("turn").parquet(f"{run}/feeds")
    dim = supplier_dim(star)
    dim = F.broadcast(dim) if star.small_frame("suppliers", dim) else dim
    refresh = Refresh(spark, f"{run}/kpi", schema, U.ORDER_KEYS, "version", measures or R.kpi_measures(), ("region",),
                      lambda rows: rows.join(dim, "supplier_id"), buckets)
    for i in range(triggers + 1):
        if path_exists(spark, f"{run}/feeds/turn={i}"):
            publish(spark, f"{run}/feeds/turn={i}", f"{run}/feed/v{i}")
        else:
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{run}/feed/v{i}")
        stream = spark.readStream.schema(schema).parquet(f"{run}/feed/v*")
        refresh.run(stream, f"{run}/ckpt").awaitTermination()
    return refresh


def r_refresh_retract(spark, sf_dir) -> DataFrame:
    """R1 with changing orders by signed deltas: every trigger reads the state of its own keys only."""
    return run_retraction(spark, load_star(spark, sf_dir), R.new_run_dir(spark, "retract")).kpis()


STREAM_QUERIES = {"r_event_time_counts": r_event_time_counts, "r_two_feeds": r_two_feeds,
                  "r_refresh_retract": r_refresh_retract,
                  "r_refresh_kpi": r_refresh_kpi, "r_daily_counts": r_daily_counts,
                  "r_monthly_counts": r_monthly_counts, "r_alert_stream": r_alert_stream,
                  "r_refresh_upsert": r_refresh_upsert}


def _oracles() -> dict:
    region_kpi = f"""
        SELECT region, count(*) AS total_orders,
               {O.rdiv("count(CASE WHEN actual_delivery_date <= expected_delivery_date THEN 1 END)",
                       "count(actual_delivery_date)", 3)} AS on_time_pct,
               {O.money(f"sum(CASE WHEN status != 'cancelled' THEN {O.VALUE} END)")} AS total_spend
        FROM pos GROUP BY region"""
    rules = " UNION ALL ".join(f"SELECT '{m}' AS measure, '{op}' AS op, CAST({t} AS DOUBLE) AS threshold"
                               for m, op, t in STREAM_ALERT_RULES)
    arrival = """order_date + CAST((order_id * 7 + line_number * 3 + product_id) % 5
            + CASE WHEN (order_id * 31 + line_number * 17 + product_id * 7) % 50 = 0 THEN 400 ELSE 0 END AS INTEGER)"""
    return {
        "r_event_time_counts": O.with_star(f"""
            SELECT order_date AS order_day, status, count(*) FILTER (WHERE NOT is_late) AS order_count,
                   count(*) FILTER (WHERE is_late) AS late_count,
                   bool_or(NOT is_late AND order_date >= latest - {DELAY_DAYS}) AS is_open
            FROM (SELECT fed.*, coalesce(order_date < before - {DELAY_DAYS}, false) AS is_late,
                         (SELECT max(order_date) FROM fed) AS latest
                  FROM fed JOIN clock USING (period)) x
            GROUP BY order_date, status""", ctes=f"""
            fed AS (SELECT *, year({arrival}) AS period FROM purchase_orders),
            clock AS (SELECT period, max(max(order_date)) OVER (ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
                      FROM fed GROUP BY period)"""),
        "r_two_feeds": O.with_star(region_kpi),
        "r_refresh_retract": O.with_star(region_kpi),
        "r_refresh_kpi": O.with_star(region_kpi),
        "r_refresh_upsert": O.with_star(region_kpi),
        "r_daily_counts": O.with_star("""
            SELECT order_date AS order_day, status, count(*) AS order_count,
                   CAST(order_date + 7 AS DATE) > (SELECT max(order_date) FROM purchase_orders) AS is_open
            FROM purchase_orders GROUP BY order_date, status"""),
        "r_monthly_counts": O.ORACLE["monthly_orders_by_status"],
        "r_alert_stream": O.with_star(f"""
            SELECT r.measure, k.region, CAST(k.on_time_pct AS DOUBLE) AS value, r.op, r.threshold,
                   true AS fired
            FROM ({region_kpi}) k JOIN ({rules}) r ON r.measure = 'on_time_pct'
            WHERE (r.op = '<' AND k.on_time_pct < r.threshold) OR (r.op = '>' AND k.on_time_pct > r.threshold)"""),
    }


STREAM_ORACLE = _oracles()
