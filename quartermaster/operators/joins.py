"""Dimension joins with a checked broadcast, plus join guards.

Only sides whose size has been *checked* are broadcast: ``is_bounded`` runs
one ``LIMIT n+1`` count (it stops reading once the limit is hit), where ``n``
is the row cap lowered by a byte budget over the estimated row width, and a
side that fails the check is joined with a shuffle instead. Literal lists
(warehouses, rules) are the only inputs broadcast without a check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension that may be broadcast: at most this many rows and this
# many estimated bytes (rows x estimated row width of the projected columns).
# Override per session with ``quartermaster.broadcast.maxRows`` / ``.maxBytes``.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024

# In-memory bytes of a value by type; the length of strings is measured.
_WIDTH = {"decimal": 16, "timestamp": 8, "timestamp_ntz": 8,
          "date": 4, "int": 4, "integer": 4, "bigint": 8, "long": 8, "double": 8, "float": 4,
          "boolean": 1, "smallint": 2, "short": 2, "tinyint": 1, "byte": 1}
_VARIABLE = ("string", "binary", "char", "varchar")
ROW_BYTES = 16


def row_width(df: DataFrame) -> int:
    """Least bytes per row of ``df``'s columns: fixed widths and a row overhead, strings empty."""
    types = [f.dataType.typeName() for f in df.schema.fields]
    return ROW_BYTES + sum(8 if t in _VARIABLE else _WIDTH.get(t, 64) for t in types)


def max_broadcast_rows(df: DataFrame) -> int:
    conf = df.sparkSession.conf
    rows = int(conf.get("quartermaster.broadcast.maxRows", None) or DEFAULT_MAX_BROADCAST_ROWS)
    return max(0, min(rows, max_broadcast_bytes(df) // row_width(df)))


def max_broadcast_bytes(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("quartermaster.broadcast.maxBytes", None) or DEFAULT_MAX_BROADCAST_BYTES)


def is_bounded(df: DataFrame, max_rows: int | None = None) -> bool:
    """True when ``df`` has few enough rows and bytes to be broadcast (one short-circuiting job).

    The rows read stop at the limit; the bytes of their strings are measured.
    With ``max_rows`` given, only the number of rows is checked.
    """
    if max_rows is not None:
        return df.limit(max_rows + 1).count() <= max_rows
    limit = max_broadcast_rows(df)
    strings = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields
               if f.dataType.typeName() in _VARIABLE]
    text = F.coalesce(F.sum(sum(strings, F.lit(0)).cast("long")), F.lit(0))
    got = df.limit(limit + 1).agg(F.count(F.lit(1)).alias("n"), text.alias("text")).first()
    return got.n <= limit and got.n * row_width(df) + got.text <= max_broadcast_bytes(df)


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
             small: bool | None = None) -> DataFrame:
    """Join ``dim`` to ``fact``: broadcast when ``small`` (checked), shuffle otherwise."""
    if small is None:
        small = is_bounded(dim)
    return fact.join(F.broadcast(dim) if small else dim, on, how)


# -- J8: cardinality guard ---------------------------------------------------
def assert_unique(df: DataFrame, key) -> DataFrame:
    """Keys that occur more than once (empty when ``key`` is unique)."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
              .where(F.col("occurrences") > 1))


# -- J9: referential guard ---------------------------------------------------
def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose ``key`` has no match in ``dim`` (an inner join would drop them)."""
    dk = dim_key or key
    d = dim.select(F.col(dk).alias("__k")).distinct()
    return fact.join(d, fact[key] == d["__k"], "left_anti")


# -- J10: zero-filled members ------------------------------------------------
def zero_fill(members: DataFrame, agg: DataFrame, key, fill: dict | int = 0) -> DataFrame:
    """Every member of ``members`` with its aggregate, missing values filled."""
    keys = [key] if isinstance(key, str) else list(key)
    out = members.join(agg, keys, "left")
    value_cols = [f for f in agg.columns if f not in keys]
    if isinstance(fill, dict):
        return out.fillna(fill)
    return out.fillna(fill, subset=value_cols)


def latest_only(df: DataFrame, date_col: str, per: list[str] | None = None) -> DataFrame:
    """Rows at the latest ``date_col``.

    ``per=None`` is the reference rule: the *global* latest date, planned by
    Catalyst as an uncorrelated scalar subquery (evaluated once, then applied as
    an ordinary filter). ``per=[keys]`` keeps each key's own latest row instead
    (T17), as a grouped max joined back on (key, date) - no window over the
    whole group, so a hot key does not land in one task.
    """
    if not per:
        latest = df.select(F.max(date_col)).scalar()
        return df.where(F.col(date_col) == latest)
    last = df.groupBy(*per).agg(F.max(date_col).alias("__latest"))
    return (df.join(last, per).where(F.col(date_col) == F.col("__latest")).drop("__latest"))

