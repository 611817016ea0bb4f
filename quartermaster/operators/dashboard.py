"""Dashboard data operations.

A dashboard here is a dict of named datasets (lazy DataFrames) plus widget
bindings. Filters are added to each dataset's plan before it runs, so Catalyst
pushes them towards the scans; nothing is computed on the driver.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from . import metrics as M
from .enrich import INVENTORY_DIMS, ORDER_DIMS, enrich_orders
from .joins import latest_only

# H1: the eight widget datasets of the reference dashboard.
DATASET_NAMES = ("kpi_total_orders", "kpi_on_time_rate", "kpi_total_spend", "kpi_low_stock",
                 "spend_by_region", "orders_over_time", "delivery_by_supplier",
                 "top_products_by_spend")


def datasets(star) -> dict[str, DataFrame]:
    from ..plans.results import RESULTS
    return {name: RESULTS[name](star) for name in DATASET_NAMES}


def publish(ds: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Expose datasets as temp views (a SQL-facing dashboard)."""
    for name, df in ds.items():
        df.createOrReplaceTempView(prefix + name)


def apply_global_filter(ds: Mapping[str, DataFrame], col: str, values: Sequence) -> dict:
    """H2: one multi-select filter bound to ``col`` on every dataset.

    Empty selection = no filter. A dataset without ``col`` is an error (the
    reference requires every dataset to carry the filter column).
    """
    missing = [n for n, df in ds.items() if col not in df.columns]
    if missing:
        raise ValueError(f"datasets without column {col!r}: {missing}")
    return {n: df.where(X.member_of(col, values)) for n, df in ds.items()}


def date_filtered_datasets(star, first_month: str, last_month: str) -> dict[str, DataFrame]:
    """T15 date filter: every dataset recomputed over orders placed in
    ``first_month``..``last_month`` (the filter applies to order rows before
    aggregation, so counters and ratios stay correct)."""
    return datasets(star.restrict(orders_where=X.in_months("order_date", first_month, last_month),
                                  months=(first_month, last_month)))


def cross_filter(ds: Mapping[str, DataFrame], bindings: Mapping[str, str], dataset: str,
                 picks: Mapping[str, object]) -> dict:
    """H3: a selection on a widget of ``dataset`` filters every widget bound to
    the same dataset and leaves the others alone. Returns widget -> DataFrame."""
    out = {}
    for widget, bound in bindings.items():
        df = ds[bound]
        if bound == dataset:
            for col, val in picks.items():
                df = df.where(F.col(col) == F.lit(val))
        out[widget] = df
    return out


def shared_orders_dataset(star) -> DataFrame:
    """H4: the wide orders dataset that makes cross-filtering useful."""
    return enrich_orders(star, dims=("suppliers", "products"))


def counter(star, values: Sequence | None = None, by: str = "region") -> DataFrame:
    """The four KPI counters per ``by`` value plus the all-values total.

    Parts (counts, sums) are merged, so the total on-time rate is the ratio of
    summed numerator and denominator - never an average of per-region rates (T5).
    """
    dim_where = {"suppliers": X.member_of(by, values)} if values else None
    inv_where = {"products": X.member_of(by, values)} if values else None
    orders = M.star_metrics(
        star, star.purchase_orders, ORDER_DIMS,
        [M.order_count("total_orders"), M.on_time_rate("on_time_pct", scale=1, digits=3),
         M.total_spend()], [by], dim_where=dim_where, keep_empty=True, parts_only=True)
    stock = M.star_metrics(star, latest_only(star.inventory_snapshots, "snapshot_date"),
                           INVENTORY_DIMS, [M.low_stock_count()], [by], dim_where=inv_where,
                           parts_only=True)
    a = M.rollup_parts(orders)
    b = M.rollup_parts(stock).withColumnRenamed(by, "__k").withColumnRenamed("is_total", "__t")
    out = a.join(b, a[by].eqNullSafe(b["__k"]) & (a["is_total"] == b["__t"]), "full")
    return out.select(F.coalesce(a[by], b["__k"]).alias(by),
                      F.coalesce(a["is_total"], b["__t"]).alias("is_total"),
                      F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
                      "on_time_pct", "total_spend",
                      F.coalesce("low_stock_count", F.lit(0)).alias("low_stock_count"))


def tidy(df: DataFrame, x: str, y: str, series: str | None = None, wide: bool = False,
         series_values: Sequence | None = None) -> DataFrame:
    """H6: chart encodings as a tidy (x, series, y) frame or a wide pivot.

    Pass ``series_values`` for the pivot; without it Spark runs an extra job to
    find the distinct series values.
    """
    if not wide or series is None:
        return df.select(x, *( [series] if series else []), y)
    g = df.groupBy(x)
    g = g.pivot(series, list(series_values)) if series_values else g.pivot(series)
    return g.agg(F.sum(y))


def format_measures(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """H7/P20: add ``<col>_display`` strings: money, percent, fraction, count."""
    fmt = {"money": X.fmt_money, "percent": X.fmt_percent, "count": X.fmt_count,
           "fraction": lambda cc: X.fmt_percent(cc, 1, fraction=True)}
    return df.withColumns({f"{col}_display": fmt[kind](col) for col, kind in spec.items()})
