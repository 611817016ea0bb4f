"""Scans of the driver-provided parquet tables."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from ..session import input_state

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Raw:
    """Named access to the raw tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return _cached_read(self.spark, self.sf_dir, name, input_state(self.spark, self.path(name)))

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"


@lru_cache(maxsize=256)
def _cached_read(spark: SparkSession, sf_dir: str, name: str, state: str) -> DataFrame:
    # Caches only the DataFrame handle (file listing + schema), never data, and
    # only for as long as the files stay as they are (``state``).
    return read_table(spark, sf_dir, name)
