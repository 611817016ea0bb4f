"""Helpers shared by the operators: table access, intermediate tables, word sets."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

# Words are maximal runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, through Spark's reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of the written part, not a
    recomputation, and a frame used twice is computed once.
    """
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
