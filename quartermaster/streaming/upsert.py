"""Changing orders: a refresh over an append-only log of row versions.

An order line changes over time (in transit -> delivered with a receipt date),
so counting arrivals would count both versions. Every micro-batch is written as
it came, into a folder of its own epoch; nothing is ever rewritten or deleted, a
replayed epoch overwrites its own folder with the same rows, and a crash leaves
the earlier epochs whole. The current state is a view of the log: the newest
version per key. KPIs are computed from that view with the batch measures.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import metrics as M

ORDER_KEYS = ("order_id", "line_number", "product_id", "occurrence")


def latest_versions(rows: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """One row per key: the one with the highest ``version``; of equal ones that of the highest hash."""
    cols = rows.columns
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), newness(rows, version)).alias("__row"))
            .select(*[F.col("__row")[c].alias(c) for c in cols]))


def newness(rows: DataFrame, version: str) -> Column:
    """What versions of a key are ordered by: the version, then a hash of the row."""
    return F.struct(F.col(version).alias("version"), F.xxhash64(*sorted(rows.columns)).alias("hash"))


def upsert_refresh(stream: DataFrame, log_path: str, checkpoint: str) -> StreamingQuery:
    """Append every micro-batch of row versions to the log, one folder per epoch."""
    def on_batch(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log_path}/epoch={epoch}")

    return (stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
                  .trigger(availableNow=True).start())


def current_state(spark: SparkSession, log_path: str, schema, keys: Sequence[str],
                  version: str = "version") -> DataFrame:
    """The newest version of every key in the log."""
    return latest_versions(spark.read.schema(schema).parquet(f"{log_path}/epoch=*"), keys, version)


def with_occurrence(orders: DataFrame) -> DataFrame:
    """Order lines with a number among those of the same order, line and product.

    The given orders repeat (order_id, line_number); quantity and price are
    values that may be corrected, so they can't be part of a key.
    """
    same = W.partitionBy("order_id", "line_number", "product_id").orderBy("quantity", "unit_cost")
    return orders.withColumn("occurrence", F.row_number().over(same))


def before_delivery(orders: DataFrame) -> dict[str, Column]:
    """The columns of order lines as they stood before delivery."""
    before = {"status": F.lit("in_transit"), "actual_delivery_date": F.lit(None).cast("date"),
              "unit_cost": (F.col("unit_cost") + 1).cast(orders.schema["unit_cost"].dataType)}
    return {c: F.when(delivered(), before[c]).otherwise(F.col(c)) if c in before else F.col(c) for c in orders.columns}


def delivered() -> Column:
    return F.col("status") == "delivered"


def order_versions(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two feeds of order-line versions derived from final order lines.

    Version 1 is every line as it stood before delivery (delivered lines still
    in transit, no receipt date, at a first price); version 2 carries the
    delivered lines' final state. Applying both must give back the final lines.
    """
    v1 = orders.select(*[x.alias(c) for c, x in before_delivery(orders).items()]).withColumn("version", F.lit(1))
    v2 = orders.where(delivered()).withColumn("version", F.lit(2))
    return v1, v2


def run_two_feeds(spark: SparkSession, orders: DataFrame, suppliers: DataFrame, run: str,
                  small_dim: bool = True, measures=None, by=("region",)) -> DataFrame:
    """KPIs of the state after both version feeds, the newer one arriving in a trigger of its own."""
    v1, v2 = order_versions(with_occurrence(orders))
    for name, feed in (("v1", v1), ("v2", v2)):
        feed.write.mode("overwrite").parquet(f"{run}/feed/{name}")
        stream = spark.readStream.schema(v1.schema).parquet(f"{run}/feed/v*")
        upsert_refresh(stream, f"{run}/log", f"{run}/ckpt").awaitTermination()
    state = current_state(spark, f"{run}/log", v1.schema, ORDER_KEYS)
    rows = state.join(F.broadcast(suppliers) if small_dim else suppliers, "supplier_id")
    measures = measures or [M.order_count("total_orders"),
                            M.on_time_rate("on_time_pct", scale=1, digits=3), M.total_spend()]
    return M.metrics(rows, measures, list(by), keep_empty=True)
