"""Registry of queries: name -> (spark, sf_dir) -> DataFrame, and their oracles."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.conform import load_star
from .results import RESULTS


def _on_star(builder) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return builder(load_star(spark, sf_dir))
    run.__name__ = getattr(builder, "__name__", "query")
    run.__doc__ = builder.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: _on_star(fn) for name, fn in RESULTS.items()}
    from .extras import EXTRA_QUERIES
    from .operations import OPERATION_QUERIES
    from .streams import STREAM_QUERIES
    from .sqlfunc_queries import SQLFUNC_QUERIES
    from .setup_queries import SETUP_QUERIES
    out.update(SQLFUNC_QUERIES)
    out.update(SETUP_QUERIES)
    out.update(EXTRA_QUERIES)
    out.update(STREAM_QUERIES)
    out.update(OPERATION_QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    from .oracle import ORACLE
    from .extras import EXTRA_ORACLE
    from .operations import OPERATION_ORACLE
    from .streams import STREAM_ORACLE
    from .sqlfunc_queries import SQLFUNC_ORACLE
    from .setup_queries import SETUP_ORACLE
    out = dict(ORACLE)
    out.update(SETUP_ORACLE)
    out.update(SQLFUNC_ORACLE)
    out.update(EXTRA_ORACLE)
    out.update(STREAM_ORACLE)
    out.update(OPERATION_ORACLE)
    return out
