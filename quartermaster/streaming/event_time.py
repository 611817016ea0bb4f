"""Event time: days that close, late lines that are kept, and a join of two feeds.

* ``split_late`` gives every line its place: a line older than the watermark (the
  latest day of the earlier epochs less the delay) goes to the late table, any
  other to the on-time log. Each epoch is published by one rename.
* ``closed_days`` (R2) reads the on-time log and counts lines per day and status
  under Spark's watermark. A day is emitted once, when it closes, and its state
  goes. The router's rule is the watermark's own, so Spark drops no line.
* ``join_feeds`` (R1) joins order lines with order headers that arrive in a feed of
  their own, within a bound of time; a line whose header hasn't come by then is
  emitted alone. ``reconciled`` looks up those lines and the late ones among
  all headers, so no arrival order loses a line.

One trigger of a reader takes all epochs that are published and never part of one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import path_exists, publish

LINES, CLOCK = "lines", "clock"
ON_TIME, LATE = "is_late=false", "is_late=true"


def split_late(stream: DataFrame, time_col: str, delay: str, out: str, checkpoint: str,
               at_mark: bool = False) -> StreamingQuery:
    """Write every epoch's lines to ``out``, late and on-time ones apart.

    A line exactly at the watermark is late where ``at_mark`` is set: so it is for
    a join, but not for a window, whose end lies after the line.

    The clock table holds one row an epoch, the latest time up to and including
    it, so an epoch reads one row of the past. A replayed epoch finds its folder
    published and changes nothing.
    """
    def route(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        if path_exists(spark, f"{out}/{CLOCK}/epoch={epoch}"):
            return
        before = _clock(spark, out, epoch - 1)
        staged = f"{out}/staged/{epoch}-{uuid.uuid4().hex[:8]}"
        mark = F.lit(before).cast("timestamp") - F.expr(f"interval {delay}")
        at = F.col(time_col).cast("timestamp")
        late = F.coalesce(at <= mark if at_mark else at < mark, F.lit(False))
        batch.withColumn("is_late", late).write.partitionBy("is_late").parquet(f"{staged}/lines")
        # the latest time comes from the written column, the feed is read once
        latest = spark.read.schema(batch.schema).parquet(f"{staged}/lines").agg(F.max(F.col(time_col).cast("timestamp")).alias("latest"))
        if before is not None:
            latest = latest.select(F.greatest("latest", F.lit(before).cast("timestamp")).alias("latest"))
        latest.write.parquet(f"{staged}/clock")
        publish(spark, f"{staged}/lines", f"{out}/{LINES}/epoch={epoch}")
        publish(spark, f"{staged}/clock", f"{out}/{CLOCK}/epoch={epoch}")

    # a batch without rows still has the feed's columns, and its folder
    return stream.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint).start()


def _clock(spark: SparkSession, out: str, epoch: int):
    if epoch < 0:
        return None
    return spark.read.schema("latest timestamp").parquet(f"{out}/{CLOCK}/epoch={epoch}").first()[0]


def on_time_stream(spark: SparkSession, schema, out: str) -> DataFrame:
    """The on-time log as a stream; a trigger takes all that is published."""
    return spark.readStream.schema(schema).parquet(f"{out}/{LINES}/epoch=*/{ON_TIME}")


def routed(spark: SparkSession, schema, out: str, late: bool) -> DataFrame:
    """All on-time or all late lines so far."""
    which = spark.read.schema(schema).option("basePath", f"{out}/{LINES}").parquet(f"{out}/{LINES}/epoch=*")
    return which.where(F.col("is_late") == late).drop("is_late", "epoch")


def closed_days(lines: DataFrame, time_col: str, delay: str, sink: str, checkpoint: str) -> StreamingQuery:
    """R2: counts per day and status, written once a day is closed by the watermark."""
    counts = (lines.withColumn("__at", F.col(time_col).cast("timestamp")).withWatermark("__at", delay)
              .groupBy(F.window("__at", "1 day").alias("w"), "status").agg(F.count(F.lit(1)).alias("order_count"))
              .select(F.col("w.start").cast("date").alias("order_day"), "status", "order_count"))

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")

    return (counts.writeStream.outputMode("append").foreachBatch(write)
            .option("checkpointLocation", checkpoint).start())


def event_counts(spark: SparkSession, schema, time_col: str, out: str, sink: str) -> DataFrame:
    """(order_day, status, order_count, late_count, is_open): closed days, open days so far, and late lines.

    Open days come from the on-time log: those after the last closed day, a range
    that the files' statistics prune to.
    """
    closed = spark.read.schema("order_day date, status string, order_count bigint").parquet(f"{sink}/epoch=*")
    last = F.coalesce(closed.agg(F.max("order_day")).scalar(), F.lit("0001-01-01").cast("date"))
    day = F.col(time_col).cast("date").alias("order_day")
    still = (routed(spark, schema, out, late=False).where(F.col(time_col).cast("date") > last)
             .groupBy(day, "status").agg(F.count(F.lit(1)).alias("order_count")))
    late = routed(spark, schema, out, late=True).groupBy(day, "status").agg(F.count(F.lit(1)).alias("late_count"))
    zero = F.lit(0).cast("bigint")
    rows = (closed.select("order_day", "status", "order_count", zero.alias("late_count"), F.lit(False).alias("is_open"))
            .unionByName(still.select("order_day", "status", "order_count", zero.alias("late_count"), F.lit(True).alias("is_open")))
            .unionByName(late.select("order_day", "status", zero.alias("order_count"), "late_count", F.lit(False).alias("is_open"))))
    return rows.groupBy("order_day", "status").agg(
        F.sum("order_count").alias("order_count"), F.sum("late_count").alias("late_count"),
        F.max("is_open").alias("is_open"))


def land(spark: SparkSession, rows: DataFrame, feed: str, period) -> None:
    """Write a period aside and give it to the feed at once: a stream that runs sees all of its files or none."""
    staged = f"{feed}-staged/{period}-{uuid.uuid4().hex[:8]}"
    rows.write.parquet(staged)
    publish(spark, staged, f"{feed}/period={period}")


def replay(spark: SparkSession, periods: list, land: Callable[[object], None],
           queries: list[Callable[[], StreamingQuery]]) -> list[StreamingQuery]:
    """Land one period after the other; each query works off what the one before it has written.

    A query starts when there is something to read, and is stopped at the end.
    """
    running: list[StreamingQuery] = []
    try:
        for period in periods:
            land(period)
            for i, start in enumerate(queries):
                if len(running) <= i:
                    running.append(start())
                running[i].processAllAvailable()
    finally:
        for q in running:
            q.stop()
    return running


def join_feeds(lines: DataFrame, headers: DataFrame, line_key: str, header_key: str, line_time: str,
               header_time: str, delay: str, bound: str, sink: str, checkpoint: str) -> StreamingQuery:
    """Lines with their headers, arrived within ``bound`` of each other; both sides' state is evicted.

    ``sink`` gets all columns of both; a line whose header has not come by the
    bound is written with the header's columns null.
    """
    left, right = lines.withWatermark(line_time, delay), headers.withWatermark(header_time, delay)
    near = F.expr(f"{line_key} = {header_key} AND {header_time} >= {line_time} - interval {bound} "
                  f"AND {header_time} <= {line_time} + interval {bound}")

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")

    return (left.join(right, near, "left_outer").writeStream.outputMode("append").foreachBatch(write)
            .option("checkpointLocation", checkpoint).start())


def reconciled(joined: DataFrame, late: DataFrame, headers: DataFrame, line_key: str, header_key: str,
               line_columns: list[str], header_columns: list[str]) -> DataFrame:
    """Lines that met their header in the stream, and all others with theirs by a batch join.

    Only the lines left over are joined again; a line without any header goes,
    as in the batch's inner join.
    """
    met = joined.where(F.col(header_key).isNotNull()).select(*line_columns, *header_columns)
    rest = (joined.where(F.col(header_key).isNull()).select(*line_columns)
            .unionByName(late.select(*line_columns)).where(F.col(line_key).isNotNull()))
    return met.unionByName(rest.join(headers.select(header_key, *[c for c in header_columns if c != header_key]),
                                     F.col(line_key) == F.col(header_key)).select(*line_columns, *header_columns))


# ---- arrival of the given tables, by fixed formulas that SQL can repeat -------------
def arrival_date(order_date: Column) -> Column:
    """When an order line arrives: up to four days after the order; one in fifty, 400 days later still."""
    day = F.pmod(F.col("order_id") * 7 + F.col("line_number") * 3 + F.col("product_id"), F.lit(5))
    slow = F.pmod(F.col("order_id") * 31 + F.col("line_number") * 17 + F.col("product_id") * 7, F.lit(50)) == 0
    return F.date_add(order_date, (day + F.when(slow, 400).otherwise(0)).cast("int"))


def header_hour(key: str) -> Column:
    """The hour an order's header arrives; every 17th comes 300 hours late."""
    return F.pmod(F.col(key) * 7919, F.lit(960)) + F.when(F.pmod(F.col(key), F.lit(17)) == 0, 300).otherwise(0)


def line_hour(key: str, line: str, part: str) -> Column:
    """The hour a line arrives: within a day of its header's usual hour; one in 23 comes 200 hours late."""
    near = F.pmod(F.col(key) * 3 + F.col(line) * 5 + F.col(part), F.lit(49))
    slow = F.when(F.pmod(F.col(key) + F.col(line), F.lit(23)) == 0, 200).otherwise(0)
    return F.pmod(F.col(key) * 7919, F.lit(960)) + near + slow


def at_hour(hour: Column) -> Column:
    return F.timestamp_seconds(F.lit(946_684_800) + hour * 3600)
