"""Incremental refresh with Structured Streaming.

* ``order_stream``: order lines conformed from arriving ``lineitem`` files; the
  static order header and supplier count are joined to each micro-batch.
* ``refresh_stream`` (R1): the batch measure builders applied to the stream;
  complete-mode result written idempotently by ``foreachBatch`` (each epoch
  overwrites the whole, small KPI table, so a replayed epoch writes the same
  bytes).
* ``run_daily_counts`` (R2): order counts per day and status, kept for every day.
* ``alert_sink`` (R3): threshold rules evaluated on every refreshed KPI batch.

State and output live under the session's checkpoint dir (shared storage on a
cluster), one new folder per run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import evaluate as E
from ..operators import metrics as M
from ..operators.joins import is_bounded
from ..session import scratch_path
from ..sources.conform import n_suppliers, purchase_orders_from
from ..sources.raw import Raw

# Micro-batches that a feed is read in, at least.
BATCHES = 4
# Rows of a landed file, at most.
FEED_ROWS = 1_000_000


def new_run_dir(spark: SparkSession, kind: str) -> str:
    return scratch_path(spark, f"streams/{kind}-{uuid.uuid4().hex[:12]}")


def order_stream(spark: SparkSession, sf_dir: str, run: str, batches: int = BATCHES) -> DataFrame:
    """Order lines of the ``lineitem`` files, arriving in ``batches`` micro-batches.

    A table of enough files is read where it is, an equal number of files at a
    time. One of fewer files is first landed in ``run``, in equal files of at
    most ``FEED_ROWS`` rows, so that no task takes a whole batch.
    """
    raw = Raw(spark, sf_dir)
    files = len(raw.lineitem.inputFiles())
    if files >= batches:
        # a file stream watches a folder or a glob; the glob is of the table alone
        folder, per_trigger = f"{sf_dir.rstrip('/')}/lineitem.parque[t]", -(-files // batches)
    else:
        folder, per_trigger = f"{run}/feed", max(1, -(-raw.lineitem.count() // (batches * FEED_ROWS)))
        raw.lineitem.repartition(batches * per_trigger).write.mode("overwrite").parquet(folder)
    stream = (spark.readStream.schema(raw.lineitem.schema).option("maxFilesPerTrigger", per_trigger)
              .parquet(folder))
    return purchase_orders_from(stream, raw.orders, n_suppliers(raw))


def kpi_measures():
    return [M.order_count("total_orders"), M.on_time_rate("on_time_pct", scale=1, digits=3),
            M.total_spend()]


def refresh_stream(stream: DataFrame, suppliers: DataFrame, sink: str, checkpoint: str,
                   measures=None, by=("region",), on_batch=None,
                   small_dim: bool | None = None) -> StreamingQuery:
    """KPI per ``by`` kept current from the order stream.

    ``suppliers`` is the static supplier dimension, broadcast to every
    micro-batch when it passes the size check (``small_dim``; checked here when
    not given), else shuffle-joined. ``on_batch(df, epoch)`` runs after each
    write (R3).
    """
    measures = measures or kpi_measures()
    if small_dim is None:
        small_dim = is_bounded(suppliers)
    rows = stream.join(F.broadcast(suppliers) if small_dim else suppliers, "supplier_id")
    agg = M.metrics(rows, measures, list(by), keep_empty=True)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(sink)
        if on_batch is not None:
            on_batch(batch, epoch)

    return (agg.writeStream.outputMode("complete").foreachBatch(write)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def run_daily_counts(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """R2: order lines per order day and status, every line counted in whatever batch it comes.

    An order's file may arrive long after later days' files, so no watermark
    closes a day: the state is one number per day and status, bounded by the
    calendar and not by the orders. Each epoch writes all counts anew, which
    makes a replay harmless.
    """
    counts = stream.groupBy(F.col("order_date").alias("order_day"), "status").agg(
        F.count(F.lit(1)).alias("order_count"))

    def write(batch: DataFrame, epoch: int) -> None:
        # days x statuses rows; a coalesce would hold the state of all partitions in one task
        batch.repartition(1).write.mode("overwrite").parquet(sink)

    return (counts.writeStream.outputMode("complete").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def mark_open(daily: DataFrame, days: int = 7) -> DataFrame:
    """Daily counts with ``is_open``: days within ``days`` of the latest one may still grow."""
    latest = daily.agg(F.max("order_day")).scalar()
    return daily.withColumn("is_open", F.date_add("order_day", days) > latest)


def rollup_daily_to_month(daily: DataFrame) -> DataFrame:
    """R2 batch step: daily counts rolled up to order month and status."""
    return (daily.withColumn("order_month", F.trunc("order_day", "month"))
                 .groupBy("order_month", "status")
                 .agg(F.sum("order_count").alias("order_count")))


ALERT_SCHEMA = "measure string, {key} string, value double, op string, threshold double, fired boolean"


def alert_sink(rules: DataFrame, sink: str, measures=("on_time_pct",), key: str = "region"):
    """A ``foreachBatch`` callback evaluating ``rules`` on each KPI batch.

    Every epoch has its own folder, overwritten by a replay and written even if
    no alert fires, so what is read is what was evaluated.
    """
    def on_batch(batch: DataFrame, epoch: int) -> None:
        values = batch.select(key, *[F.col(m).cast("double").alias(m) for m in measures]) \
                      .unpivot([key], list(measures), "measure", "value")
        fired = E.alerts(values, rules).where("fired").select("measure", key, "value", "op", "threshold", "fired")
        fired.write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")
    return on_batch


def read_alerts(spark: SparkSession, sink: str, key: str = "region", latest: bool = False) -> DataFrame:
    """The fired alerts with their epoch; ``latest``: those of the last epoch alone.

    A sink that can't be read is an error; one without alerts is an empty frame.
    """
    df = spark.read.schema(ALERT_SCHEMA.format(key=key) + ", epoch int").parquet(sink)
    if latest:
        path = F.regexp_extract(F.col("path"), r"/epoch=(\d+)/", 1).cast("int")
        files = spark.read.format("binaryFile").load(f"{sink}/epoch=*/*.parquet").select("path")
        df = df.where(F.col("epoch") == files.agg(F.max(path)).scalar())
    return df
