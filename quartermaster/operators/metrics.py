"""Governed measures and the one aggregation operator.

A ``Measure`` is a set of *re-aggregable parts* (sum / count / min / max of a
row expression, optionally under the measure's own filter) and a final
expression over the merged parts. That split is what lets

* many measures share one scan (``metrics``: each measure's filter is folded
  into a conditional aggregate, B14);
* ratios stay correct under any grouping, filter or roll-up: numerator and
  denominator are merged, never the ratio itself (B10, T5);
* a large fact be pre-aggregated at its foreign-key grain *before* joining a
  large dimension (``star_metrics`` "eager" plan), so the join and the final
  shuffle carry one row per key instead of one per order line.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from .joins import is_bounded

_AGG = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Part:
    fn: str            # sum | count | min | max
    expr: Column


@dataclass(frozen=True)
class Measure:
    name: str
    parts: tuple                      # ((part_name, Part), ...)
    final: Callable[[Callable[[str], Column]], Column]
    where: Column | None = None
    where_key: str | None = None      # identity of ``where`` (hoisting a shared filter)
    needs: tuple = ()                 # dimension columns the row expressions read
    description: str = ""
    synonyms: tuple = ()

    def alias(self, name: str) -> "Measure":
        return replace(self, name=name)

    def restrict(self, where: Column, key: str) -> "Measure":
        """The same measure under an additional row filter."""
        w = where if self.where is None else (self.where & where)
        k = key if self.where_key is None else f"{self.where_key}&{key}"
        return replace(self, where=w, where_key=k)

    # column names of the parts in an aggregated frame
    def col(self, part: str) -> str:
        return f"{self.name}__{part}"


def measure(name: str, parts: dict[str, tuple[str, Column]], final, where=None,
            where_key=None, needs=(), description="", synonyms=()) -> Measure:
    return Measure(name=name, parts=tuple((k, Part(fn, e)) for k, (fn, e) in parts.items()),
                   final=final, where=where, where_key=where_key, needs=tuple(needs),
                   description=description, synonyms=tuple(synonyms))


# ---- phases --------------------------------------------------------------------
def _partials(measures: Sequence[Measure], fold: bool) -> list[Column]:
    out = []
    for m in measures:
        for pname, p in m.parts:
            e = p.expr
            if fold and m.where is not None:
                e = F.when(m.where, e)
            out.append(_AGG[p.fn](e).alias(m.col(pname)))
        if fold and m.where is not None:
            out.append(F.count(F.when(m.where, F.lit(1))).alias(m.col("__rows")))
    return out


def _merges(measures: Sequence[Measure], fold: bool) -> list[Column]:
    out = []
    for m in measures:
        for pname, p in m.parts:
            out.append(_MERGE[p.fn](F.col(m.col(pname))).alias(m.col(pname)))
        if fold and m.where is not None:
            out.append(F.sum(F.col(m.col("__rows"))).alias(m.col("__rows")))
    return out


def _finals(measures: Sequence[Measure]) -> list[Column]:
    return [m.final(lambda p, m=m: F.col(m.col(p))).alias(m.name) for m in measures]


def _plan_filters(measures: Sequence[Measure], where: Column | None, keep_empty: bool = False):
    """Hoist a filter shared by every measure into a row filter (pushdown).

    Not when empty groups are kept: a group without a qualifying row has to stay.
    """
    by_key: dict[str, str] = {}
    for m in measures:
        if m.where_key is not None and by_key.setdefault(m.where_key, str(m.where)) != str(m.where):
            raise ValueError(f"two filters under the name {m.where_key!r}")
    keys = {m.where_key for m in measures}
    if len(keys) == 1 and None not in keys and not keep_empty:
        shared = measures[0].where
        rows_where = shared if where is None else (where & shared)
        return rows_where, [replace(m, where=None, where_key=None) for m in measures], False
    return where, list(measures), any(m.where is not None for m in measures)


def _keep_nonempty(df: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    cnts = [F.col(m.col("__rows")) for m in measures if m.where is not None]
    if not cnts or len(cnts) < len(measures):
        return df     # some measure counts every row of the group: never empty
    cond = cnts[0] > 0
    for cc in cnts[1:]:
        cond = cond | (cc > 0)
    return df.where(cond)


@dataclass
class Parts:
    """Merged, not yet finalised measure parts (input of ``rollup_parts``)."""
    df: DataFrame
    measures: list
    fold: bool
    by: list


def metrics(df: DataFrame, measures: Sequence[Measure], by: Sequence = (),
            where: Column | None = None, keep_empty: bool = False, parts_only: bool = False):
    """``df.where(where).groupBy(by).agg(measures)`` in one scan.

    Groups in which no measure saw a qualifying row are dropped unless
    ``keep_empty`` (T21: matches filter-first SQL).
    """
    rows_where, ms, fold = _plan_filters(measures, where, keep_empty)
    rows = df.where(rows_where) if rows_where is not None else df
    by = list(by)
    agg = rows.groupBy(*by).agg(*_partials(ms, fold))
    if fold and not keep_empty and by:      # a global aggregate always has its one row
        agg = _keep_nonempty(agg, ms)
    if parts_only:
        return Parts(agg, ms, fold, by)
    return agg.select(*by, *_finals(ms))


def rollup_parts(parts: Parts) -> DataFrame:
    """ROLLUP over the group keys of already merged parts, finalised.

    Runs on the aggregated parts (one row per group), so the roll-up never
    expands order lines; ratios of the subtotal rows are recomputed from their
    merged numerator and denominator. ``is_total`` marks subtotal/total rows.
    """
    agg = parts.df.rollup(*parts.by).agg(*_merges(parts.measures, parts.fold),
                                         (F.grouping_id() > 0).alias("is_total"))
    return agg.select(*parts.by, "is_total", *_finals(parts.measures))


def grouping_sets(parts: Parts, sets: Sequence[Sequence[str]]) -> DataFrame:
    """B15 over several keys: the measures of every grouping set, from parts merged once.

    ``grouped_by`` names the keys of a row's set (comma-separated, empty for the
    total); the other keys are null. The expansion sees one row per group of the
    parts, never order lines, and the facts are scanned once.
    """
    agg = parts.df.groupingSets([list(s) for s in sets], *parts.by).agg(
        *_merges(parts.measures, parts.fold), *[F.grouping(c).alias(f"__g_{c}") for c in parts.by])
    if parts.fold:
        agg = _keep_nonempty(agg, parts.measures)
    grouped = F.concat_ws(",", *[F.when(F.col(f"__g_{c}") == 0, F.lit(c)) for c in parts.by])
    return agg.select(*parts.by, grouped.alias("grouped_by"), *_finals(parts.measures))


# ---- eager aggregation over a star ------------------------------------------------
@dataclass
class DimSpec:
    name: str                     # attribute of the Star
    key: str                      # fact foreign key == dimension key column
    columns: tuple                # attributes this dimension provides
    frame: Callable               # star -> DataFrame (already projected)


def star_metrics(star, fact: DataFrame, dims: Sequence[DimSpec], measures: Sequence[Measure],
                 by: Sequence[str] = (), where: Column | None = None,
                 dim_where: dict | None = None, keep_empty: bool = False,
                 strategy: str = "auto", parts_only: bool = False):
    """Aggregate a fact by fact and dimension attributes.

    ``strategy``: ``broadcast`` joins (checked-small) dimensions to the rows and
    aggregates once; ``eager`` first aggregates the fact at the foreign-key grain,
    then shuffle-joins the dimensions and merges the parts; ``auto`` picks
    broadcast when every needed dimension passes the size check, else eager
    (falls back to a row-level shuffle join when a measure reads a dimension
    column).
    """
    dim_where = dim_where or {}
    by = list(by)
    needed = []
    for d in dims:
        used = [c for c in by if c in d.columns] + [c for m in measures for c in m.needs if c in d.columns]
        if used or d.name in dim_where:
            needed.append(d)
    fact_by = [c for c in by if not any(c in d.columns for d in needed)]
    if not needed:                          # nothing to join: one aggregation
        return metrics(fact, measures, by, where, keep_empty, parts_only)

    def dim_frame(d: DimSpec) -> DataFrame:
        f = d.frame(star)
        if d.name in dim_where:
            f = f.where(dim_where[d.name])
        return f

    if strategy == "auto":
        all_small = all(star.small_frame(d.name, d.frame(star)) for d in needed)
        reads_dims = any(m.needs for m in measures)
        strategy = "broadcast" if all_small else ("shuffle" if reads_dims else "eager")

    if strategy in ("broadcast", "shuffle"):
        rows = fact
        for d in needed:
            f = dim_frame(d)
            rows = rows.join(F.broadcast(f) if strategy == "broadcast" else f, d.key)
        return metrics(rows, measures, by, where, keep_empty, parts_only)

    # eager: partial aggregation at (fact keys + foreign keys), then join, then merge.
    rows_where, ms, fold = _plan_filters(measures, where, keep_empty)
    rows = fact.where(rows_where) if rows_where is not None else fact
    for d in needed:
        if d.name in dim_where:
            rows = reduced(rows, d.key, d.frame(star).select(d.key), dim_frame(d).select(d.key))
    fks = [d.key for d in needed]
    pre = rows.groupBy(*(fact_by + [k for k in fks if k not in fact_by])).agg(*_partials(ms, fold))
    for d in needed:       # one row per key now; a dimension that passes the check is broadcast
        f = dim_frame(d)
        pre = pre.join(F.broadcast(f) if star.small_frame(d.name, f) else f, d.key)
    agg = pre.groupBy(*by).agg(*_merges(ms, fold))
    if fold and not keep_empty and by:
        agg = _keep_nonempty(agg, ms)
    if parts_only:
        return Parts(agg, ms, fold, by)
    return agg.select(*by, *_finals(ms))


# A filter that keeps more than this share of a dimension's keys isn't worth a pass over them.
REDUCE_BELOW = 0.5
FILTER_BITS, MOST_BITS = 16, 1 << 27


def reduced(fact: DataFrame, key: str, all_keys: DataFrame, kept: DataFrame) -> DataFrame:
    """The fact rows that may join the ``kept`` keys, before they are aggregated.

    Kept keys that pass the size check are broadcast for a semi-join. More of them
    become a bit array of 16 bits a key (2**27 bits at most, stored in rows of 64), which is
    what is broadcast: a few rows of other keys pass and go in the join that
    follows. A filter that keeps most keys leaves the fact as it is.
    """
    n = kept.count()
    if n > REDUCE_BELOW * all_keys.count():
        return fact
    if is_bounded(kept):
        return fact.join(F.broadcast(kept.distinct()), key, "left_semi")
    bits = min(-(-n * FILTER_BITS // 64) * 64, MOST_BITS)
    at = F.pmod(F.xxhash64(key), F.lit(bits))
    words = (kept.select((at / 64).cast("int").alias("__word"), (at % 64).cast("int").alias("__bit")).distinct()
             .groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits")))
    probe = fact.withColumns({"__word": (at / 64).cast("int"), "__bit": (at % 64).cast("int")})
    hit = probe.join(F.broadcast(words), "__word")
    return hit.where(F.expr("shiftrightunsigned(__bits, __bit) & 1 = 1")).select(*fact.columns)


# ---- the measure catalogue (M1-M15) ---------------------------------------------
def NOT_CANCELLED() -> Column:
    return F.col("status") != "cancelled"


def RECEIVED() -> Column:
    return F.col("actual_delivery_date").isNotNull()


def LATE() -> Column:
    return (F.col("status") == "delivered") & (F.col("actual_delivery_date") > F.col("expected_delivery_date"))


def LOW_STOCK() -> Column:
    """M4: on hand below the reorder point."""
    return F.col("quantity_on_hand") < F.col("reorder_point")


def total_spend(name="total_spend") -> Measure:
    """M1: sum of quantity x unit price over orders that are not cancelled."""
    return measure(name, {"v": ("sum", X.order_value())}, lambda p: X.money_out(p("v")),
                   where=NOT_CANCELLED(), where_key="not_cancelled",
                   description="Total spend, cancelled orders excluded",
                   synonyms=("spend", "total cost"))


def order_value_total(name="order_value") -> Measure:
    """Sum of quantity x unit price over all statuses (order value, not spend)."""
    return measure(name, {"v": ("sum", X.order_value())}, lambda p: X.money_out(p("v")))


def on_time_rate(name="on_time_delivery_rate", scale=100, digits=1) -> Measure:
    """M2: on-time receipts / receipts; percent 1 dp by default, NULL if none."""
    return measure(name,
                   {"on_time": ("count", F.when(X.on_time(), F.lit(1))),
                    "received": ("count", F.col("actual_delivery_date"))},
                   lambda p: X.ratio(p("on_time"), p("received"), scale, digits),
                   where=RECEIVED(), where_key="received",
                   description="Share of received orders delivered on or before the expected date",
                   synonyms=("on-time rate", "OTD rate", "delivery performance"))


def order_count(name="order_count") -> Measure:
    """M5: every order line, all statuses."""
    return measure(name, {"n": ("count", F.lit(1))}, lambda p: p("n"))


def avg_order_value(name="avg_order_value") -> Measure:
    """M6: mean line value of orders that are not cancelled, 2 dp."""
    return measure(name, {"v": ("sum", X.order_value()), "n": ("count", F.lit(1))},
                   lambda p: X.avg_exact(p("v"), p("n"), 2),
                   where=NOT_CANCELLED(), where_key="not_cancelled")


def avg_variance_days(name="avg_days_variance", digits=1) -> Measure:
    """M7: mean signed (actual - expected) days over received orders."""
    return measure(name, {"d": ("sum", X.variance_days()), "n": ("count", F.col("actual_delivery_date"))},
                   lambda p: X.avg_exact(p("d"), p("n"), digits),
                   where=RECEIVED(), where_key="received")


def late_orders(name="late_orders") -> Measure:
    """M8 (count part): delivered orders received after the expected date."""
    return measure(name, {"n": ("count", F.lit(1))}, lambda p: p("n"), where=LATE(), where_key="late")


def avg_days_late(name="avg_days_late", digits=1) -> Measure:
    """M8: mean days late over late deliveries."""
    return measure(name, {"d": ("sum", X.days_late()), "n": ("count", X.days_late())},
                   lambda p: X.avg_exact(p("d"), p("n"), digits), where=LATE(), where_key="late")


def avg_actual_lead_days(name="avg_actual_lead_days", digits=1) -> Measure:
    """M9: mean datediff(actual, order_date) over received orders."""
    return measure(name, {"d": ("sum", X.lead_days()), "n": ("count", F.col("actual_delivery_date"))},
                   lambda p: X.avg_exact(p("d"), p("n"), digits),
                   where=RECEIVED(), where_key="received")


def avg_contracted_lead_days(name="avg_contracted_lead_days", digits=1) -> Measure:
    """Mean lead_time_days over the rows given (suppliers, or their orders)."""
    return measure(name, {"d": ("sum", F.col("lead_time_days")), "n": ("count", F.col("lead_time_days"))},
                   lambda p: X.avg_exact(p("d"), p("n"), digits), needs=("lead_time_days",))


def low_stock_count(name="low_stock_count") -> Measure:
    """Item-warehouse rows below their reorder point (apply to latest rows)."""
    return measure(name, {"n": ("count", F.lit(1))}, lambda p: p("n"),
                   where=LOW_STOCK(), where_key="low_stock",
                   synonyms=("at-risk items", "below reorder point"))


def delayed_count(name="delayed_orders") -> Measure:
    """Orders whose status is ``delayed``."""
    return measure(name, {"n": ("count", F.lit(1))}, lambda p: p("n"),
                   where=F.col("status") == "delayed", where_key="status_delayed")


def total_quantity(name="total_quantity") -> Measure:
    """Sum of ordered units (BIGINT)."""
    return measure(name, {"q": ("sum", F.col("quantity").cast("bigint"))}, lambda p: p("q"))


def avg_quantity(name="avg_quantity", digits=0) -> Measure:
    """Mean ordered units, 0 dp."""
    return measure(name, {"q": ("sum", F.col("quantity").cast("bigint")), "n": ("count", F.col("quantity"))},
                   lambda p: X.avg_exact(p("q"), p("n"), digits))


def count_rows(name="n") -> Measure:
    return measure(name, {"n": ("count", F.lit(1))}, lambda p: p("n"))


def cost_stats(prefix="") -> list[Measure]:
    """Product count and avg/min/max standard unit cost (2 dp)."""
    uc = F.col("unit_cost")
    return [
        count_rows(prefix + "product_count"),
        measure(prefix + "avg_unit_cost", {"s": ("sum", uc), "n": ("count", uc)},
                lambda p: X.avg_exact(p("s"), p("n"), 2)),
        measure(prefix + "min_cost", {"m": ("min", uc)}, lambda p: X.money_out(p("m"))),
        measure(prefix + "max_cost", {"m": ("max", uc)}, lambda p: X.money_out(p("m"))),
    ]


CATALOGUE = {
    "total_spend": total_spend, "order_value": order_value_total,
    "on_time_delivery_rate": on_time_rate, "order_count": order_count,
    "avg_order_value": avg_order_value, "avg_days_variance": avg_variance_days,
    "late_orders": late_orders, "avg_days_late": avg_days_late,
    "avg_actual_lead_days": avg_actual_lead_days,
    "avg_contracted_lead_days": avg_contracted_lead_days,
    "low_stock_count": low_stock_count, "delayed_orders": delayed_count,
    "total_quantity": total_quantity, "avg_quantity": avg_quantity,
}


def measure_for(term: str) -> Measure:
    """The catalogue measure named by ``term`` or one of its synonyms
    (case-insensitive exact match; a dictionary lookup, not a parser)."""
    t = term.strip().lower()
    for name, build in CATALOGUE.items():
        m = build()
        if t == name.lower() or t in (s.lower() for s in m.synonyms):
            return m
    raise KeyError(term)
