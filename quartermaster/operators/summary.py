"""H1-H3 from a stored summary: dashboard datasets without another pass over the order lines.

A summary holds the parts of its measures at its grain: the dashboard's order
measures by order month, status and supplier, those of the products by status and
product, and low stock by supplier. The one by month is stored by month, so a refresh
reads and writes the months that changed; the others are made anew. A
request (measures, keys, filters) is contained if the grain has all of its keys and
filter columns and the summary all of its parts; it is then merged from
the summary, where ratios come from merged numerators and denominators. Any other
request goes to the rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..session import path_exists, publish, scratch_path
from . import metrics as M
from .analysis import top_n
from .enrich import INVENTORY_DIMS, ORDER_DIMS
from .joins import latest_only

MONTH = "order_month"


@dataclass(frozen=True)
class Grain:
    """A summary's keys and measures."""

    name: str
    keys: tuple
    measures: tuple
    fact: str = "orders"


def order_measures() -> tuple:
    return (M.order_count("total_orders"), M.on_time_rate("on_time_pct", scale=1, digits=3), M.total_spend(),
            M.avg_variance_days(), M.total_quantity())


def grains() -> tuple:
    """The dashboard's summaries."""
    return (
        Grain("orders", (MONTH, "status", "region", "supplier_name"), order_measures()),
        Grain("products", ("status", "region", "supplier_name", "product_name", "category"),
              (M.total_quantity(), M.total_spend())),
        Grain("stock", ("region", "supplier_name"), (M.low_stock_count(),), fact="stock"),
    )


@dataclass(frozen=True)
class Request:
    """What a dataset asks for; ``where`` is a condition on ``where_columns`` alone."""

    measures: tuple
    by: tuple
    where: Column | None = None
    where_columns: tuple = ()


def _monthly(grain: Grain) -> bool:
    return MONTH in grain.keys


def contained(request: Request, grain: Grain) -> bool:
    """Can ``grain`` answer ``request``? Measures are the same by their parts and their filter."""
    parts = {_identity(m) for m in grain.measures}
    return ({*request.by, *request.where_columns} <= set(grain.keys)
            and all(_identity(m) in parts for m in request.measures))


def _identity(m: M.Measure) -> str:
    return repr([(n, p.fn, str(p.expr)) for n, p in m.parts] + [str(m.where)])


class Summary:
    """The stored summaries of a star."""

    def __init__(self, star, path: str | None = None, of: Sequence[Grain] | None = None) -> None:
        self.star, self.grains = star, tuple(of or grains())
        self.path = path or (f"{star.path}/summary_v1" if star.path else scratch_path(star.spark, f"summary/{uuid.uuid4().hex}"))

    # ---- writing ----------------------------------------------------------------
    def _parts(self, grain: Grain, months: tuple[str, str] | None) -> DataFrame:
        star = self.star
        if grain.fact == "stock":
            rows = M.star_metrics(star, latest_only(star.inventory_snapshots, "snapshot_date"), INVENTORY_DIMS,
                                  list(grain.measures), list(grain.keys), keep_empty=True, parts_only=True)
            return rows.df
        orders = star.orders_of(*months) if months else star.purchase_orders
        if months:
            orders = orders.where(X.in_months("order_date", *months))
        if _monthly(grain):
            orders = orders.withColumn(MONTH, X.month_start("order_date"))
        return M.star_metrics(star, orders, ORDER_DIMS, list(grain.measures), list(grain.keys), keep_empty=True,
                              parts_only=True).df

    def _write(self, grain: Grain, df: DataFrame, folder: str) -> None:
        staged = f"{self.path}/_staged-{uuid.uuid4().hex[:8]}"
        if _monthly(grain):
            df = df.withColumn("stored", F.date_format(MONTH, "yyyy-MM")).hint("rebalance", F.col("stored"))
            df.write.partitionBy("stored").parquet(staged)
        else:
            df.write.parquet(staged)
        publish(self.star.spark, staged, folder)

    def build(self) -> Summary:
        """Write each summary that isn't there yet."""
        for grain in self.grains:
            if not path_exists(self.star.spark, f"{self.path}/{grain.name}/v=0"):
                self._write(grain, self._parts(grain, None), f"{self.path}/{grain.name}/v=0")
        return self

    def refresh(self, first: str, last: str) -> None:
        """Compute months ``first``..``last`` (YYYY-MM) anew; a month's newest version counts.

        Only these months' order lines are read; the other months stay as stored.
        """
        for grain in self.grains:
            v = self._versions(grain)[-1] + 1
            if _monthly(grain):
                # the span first: without its version it counts for nothing
                span = self.star.spark.createDataFrame([(first, last)], "first string, last string")
                span.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{grain.name}/span={v}")
            self._write(grain, self._parts(grain, (first, last) if _monthly(grain) else None),
                        f"{self.path}/{grain.name}/v={v}")

    def _versions(self, grain: Grain) -> list[int]:
        spark = self.star.spark
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{grain.name}/v=*")
        found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
        return sorted(int(x.getPath().getName()[2:]) for x in found)

    # ---- reading ------------------------------------------------------------------
    def read(self, grain: Grain) -> DataFrame:
        """The newest parts of every month."""
        spark, out, versions = self.star.spark, None, self._versions(grain)
        if not _monthly(grain):
            return spark.read.parquet(f"{self.path}/{grain.name}/v={versions[-1]}")
        newer: list[tuple[str, str]] = []
        for v in reversed(versions):
            rows = spark.read.parquet(f"{self.path}/{grain.name}/v={v}")
            for first, last in newer:
                rows = rows.where(~F.col("stored").between(first, last))
            rows = rows.drop("stored")
            out = rows if out is None else out.unionByName(rows)
            if v:
                newer.append(tuple(spark.read.parquet(f"{self.path}/{grain.name}/span={v}").first()))
        return out

    def answer(self, request: Request, fallback=None) -> DataFrame:
        """``request`` from the first summary that contains it, else from ``fallback``'s rows."""
        for grain in self.grains:
            if contained(request, grain):
                return self._merged(grain, request)
        if fallback is None:
            raise ValueError("no summary contains the request, and no rows to go back to were given")
        return fallback()

    def _merged(self, grain: Grain, request: Request) -> DataFrame:
        stored = {_identity(m): m for m in grain.measures}
        own = [stored[_identity(m)].alias(m.name) for m in request.measures]
        rows = self.read(grain)
        rename = {stored[_identity(m)].col(p): m.col(p) for m in request.measures
                  for p in [*[n for n, _ in m.parts], *(["__rows"] if m.where is not None else [])]}
        rows = rows.withColumnsRenamed({a: b for a, b in rename.items() if a != b})
        if request.where is not None:
            rows = rows.where(request.where)
        agg = rows.groupBy(*request.by).agg(*M._merges(own, True))
        agg = M._keep_nonempty(agg, own)
        return agg.select(*request.by, *M._finals(own))


def dataset_requests(where: Column | None = None, where_columns: tuple = ()) -> dict[str, Request]:
    """The eight dashboard datasets as requests; ``where`` is the filter of all of them.

    The Top-10 is filtered after its limit (T6), so its request has no filter.
    """
    def ask(by, *measures):
        return Request(measures, by, where, where_columns)

    return {
        "kpi_total_orders": ask(("region",), M.order_count("total_orders")),
        "kpi_on_time_rate": ask(("region",), M.on_time_rate("on_time_pct", scale=1, digits=3)),
        "kpi_total_spend": ask(("region",), M.total_spend()),
        "kpi_low_stock": ask(("region",), M.low_stock_count()),
        "spend_by_region": ask(("region",), M.total_spend()),
        "orders_over_time": ask(("region", MONTH, "status"), M.order_count()),
        "delivery_by_supplier": ask(("region", "supplier_name"), M.avg_variance_days()),
        "top_products_by_spend": Request((M.total_quantity(), M.total_spend()),
                                         ("region", "product_name", "category", "supplier_name"),
                                         M.NOT_CANCELLED(), ("status",)),
    }


def filtered_datasets(summary: Summary, col: str, values: Sequence) -> dict[str, DataFrame]:
    """H2: the eight datasets under a multi-select filter, from the summary.

    A filter on a column that a summary hasn't got goes to the dataset's rows.
    """
    from ..plans.results import RESULTS
    picked = X.member_of(col, values)
    out = {}
    for name, request in dataset_requests(picked, (col,)).items():
        def rows(name=name):
            return RESULTS[name](summary.star).where(picked)

        found = summary.answer(request, rows)
        if name == "top_products_by_spend":
            found = top_n(found, [F.col("total_spend").desc(), "product_name", "supplier_name", "region", "category"],
                          10).where(picked)
        out[name] = found
    return out
