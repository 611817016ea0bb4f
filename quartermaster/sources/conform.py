"""The supply-chain star, derived lazily from the driver's TPC-H-like tables.

The reference's four tables (suppliers, products, purchase_orders,
inventory_snapshots) do not exist in the test data; this module maps the raw
tables onto them with deterministic integer formulas that DuckDB can repeat
exactly (see ``plans/oracle.py``). Nothing is collected: each star table is a
lazy DataFrame whose plan Catalyst prunes and pushes filters through.

Mapping (README "Star mapping" lists the reasons):

* suppliers   <- supplier ⋈ nation ⋈ region; lead time and rating from the key.
* products    <- part; the single supplier of a product is ``partkey mod #suppliers``.
* purchase_orders <- lineitem ⋈ orders, one row per order line. The supplier and
  its lead time follow from ``l_partkey`` by the same formula, so the fact needs
  no join to products or suppliers; the order's unit price is the line's own
  price ``l_extendedprice / l_quantity`` (2 dp).
* inventory_snapshots <- products x 4 warehouses x 17 weekly dates, generated
  with two ``explode``s (narrow, no shuffle).
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import threading
from collections.abc import Callable
from copy import copy
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import MONEY
from ..operators.joins import is_bounded, join_dim, max_broadcast_rows
from ..session import input_state, path_exists, scratch_path
from .raw import Raw

# ---- fixed values (must stay as written) -------------------------------------
# Warehouses, in the reference's order (index = position below).
WAREHOUSES = ("Chicago", "Atlanta", "Seattle", "Dallas")
# Order statuses.
STATUSES = ("delivered", "in_transit", "delayed", "cancelled")
# Weekly snapshot calendar of the conformed star: 17 weeks from this Monday.
SNAPSHOT_START = _dt.date(2000, 11, 6)
SNAPSHOT_WEEKS = 17
# Reference months moved into the test data's years (2024-10 -> 2000-10, ...).
BASE_MONTH = "2000-10"
COMPARE_FIRST, COMPARE_LAST = "2000-11", "2000-12"
ETA_MONTH = "2001-01"
# Region used by the "suppliers in a region" benchmark question.
BENCH_REGION = "ASIA"
# Most days from order to expected delivery under the formulas below: lead 3..30, offset -2..5.
MAX_LEAD_DAYS = 35


def n_suppliers(raw: Raw) -> DataFrame:
    """One-row frame with the supplier count (drives ``product -> supplier``)."""
    return raw.supplier.agg(F.count(F.lit(1)).alias("__n_supp"))


def n_suppliers_value(n_supp: DataFrame) -> "F.Column":
    """The supplier count as an uncorrelated scalar subquery (evaluated once)."""
    return n_supp.select("__n_supp").scalar()


def product_supplier(partkey, n_supp) -> "F.Column":
    """The single supplier of a product: ``partkey mod #suppliers``."""
    return F.pmod(partkey, n_supp)


def lead_time_of(supplier_id) -> "F.Column":
    return (F.lit(3) + F.pmod(supplier_id, F.lit(28))).cast("int")


def conform_suppliers(raw: Raw) -> DataFrame:
    # nation and region are 25 and 5 rows in TPC-H; they are still broadcast
    # only after the row-count check (join_dim), like every other dimension.
    r = raw.region.select("r_regionkey", "r_name")
    geo = (join_dim(raw.nation.select("n_nationkey", "n_name", "n_regionkey"), r,
                    F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("region")))
    s = raw.supplier.select("s_suppkey", "s_name", "s_nationkey")
    return (join_dim(s, geo, s["s_nationkey"] == geo["n_nationkey"])
             .select(F.col("s_suppkey").alias("supplier_id"),
                     F.col("s_name").alias("supplier_name"),
                     "region", "country",
                     lead_time_of(F.col("s_suppkey")).alias("lead_time_days"),
                     ((F.lit(20) + F.pmod(F.col("s_suppkey") * 7, F.lit(31))).cast("double") / 10)
                     .alias("reliability_rating")))


def conform_products(raw: Raw) -> DataFrame:
    p = raw.part.select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    n_supp = n_suppliers_value(n_suppliers(raw))
    return (p.withColumn("__n_supp", n_supp)
             .select(F.col("p_partkey").alias("product_id"),
                     F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string"))
                     .alias("product_name"),
                     F.col("p_type").alias("category"),
                     F.col("p_retailprice").cast(MONEY).alias("unit_cost"),
                     product_supplier(F.col("p_partkey"), F.col("__n_supp")).alias("supplier_id"),
                     F.col("p_size").cast("double").alias("weight_kg")))


def status_of(linestatus, returnflag) -> "F.Column":
    return (F.when(linestatus == "F", F.lit("delivered"))
             .when(returnflag == "N", F.lit("in_transit"))
             .when(returnflag == "A", F.lit("delayed"))
             .when(returnflag == "R", F.lit("cancelled")))


def conform_purchase_orders(raw: Raw) -> DataFrame:
    return purchase_orders_from(raw.lineitem, raw.orders, n_suppliers(raw))


def purchase_orders_from(lineitem: DataFrame, orders: DataFrame, n_supp: DataFrame,
                         lay: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Order lines of the star from lineitem rows (batch or streaming).

    ``lay`` deals out the joined rows before the columns that follow from others
    are added, so that an exchange moves what is given alone; it may add ``ORDER_MONTH``.
    """
    o = orders.select(F.col("o_orderkey"), F.col("o_orderdate").cast("date").alias("order_date"))
    joined = join_orders(line_values(lineitem), o).drop("o_orderkey")
    return _dated(lay(joined) if lay else joined, n_supp)


def line_values(lineitem: DataFrame) -> DataFrame:
    """What an order line takes from its own lineitem row: keys, quantity, unit price and status."""
    unit = F.round(F.try_divide(F.col("l_extendedprice").cast("decimal(15,2)"),
                                F.col("l_quantity").cast("decimal(10,0)")), 2).cast(MONEY)
    return lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("quantity"),
                           unit.alias("unit_cost"),
                           status_of(F.col("l_linestatus"), F.col("l_returnflag")).alias("status"),
                           *[c for c in ("order_date",) if c in lineitem.columns])


def order_lines(joined: DataFrame, n_supp: DataFrame) -> DataFrame:
    """Order lines of the star from lineitem rows with their ``order_date``."""
    return _dated(line_values(joined), n_supp)


def _dated(lines: DataFrame, n_supp: DataFrame) -> DataFrame:
    """Supplier and dates of order lines, which follow from their keys, order date and status."""
    j = lines.withColumn("__n_supp", n_suppliers_value(n_supp))
    supplier_id = product_supplier(F.col("l_partkey"), F.col("__n_supp"))
    expected = F.date_add(F.col("order_date"),
                          lead_time_of(supplier_id)
                          + F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(8)).cast("int") - 2)
    actual_off = (F.pmod(F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17 + F.col("l_partkey") * 7,
                         F.lit(14)).cast("int") - 3)
    j = j.withColumn("expected_delivery_date", expected)
    actual = F.when(F.col("status") == "delivered",
                    F.date_add(F.col("expected_delivery_date"), actual_off))
    return j.select(F.col("l_orderkey").alias("order_id"),
                    F.col("l_linenumber").alias("line_number"),
                    F.col("l_partkey").alias("product_id"),
                    supplier_id.alias("supplier_id"),
                    "order_date", "expected_delivery_date",
                    actual.alias("actual_delivery_date"),
                    "quantity", "unit_cost", "status", *[c for c in (ORDER_MONTH,) if c in j.columns])


def join_orders(li: DataFrame, o: DataFrame) -> DataFrame:
    """lineitem ⋈ orders on the order key: the one large-large join of the star.

    With AQE skew-join splitting on (the default) this is a plain equi-join:
    Spark builds a hash table of each partition of ``o``, the smaller side, so that
    neither side is sorted (nor spilled), and splits a hot order key's partition
    at run time. Without it, a hot key is split by
    salting: each line gets a hash salt in [0, S) and the two-column order side
    is replicated once per salt value (S = ``quartermaster.join.salts``, 8), so
    one order key's lines spread over S tasks.
    """
    spark = li.sparkSession
    aqe_skew = (spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
                and spark.conf.get("spark.sql.adaptive.skewJoin.enabled", "true").lower() == "true")
    if aqe_skew or li.isStreaming:
        return li.join(o.hint("shuffle_hash"), li["l_orderkey"] == o["o_orderkey"])
    salts = int(spark.conf.get("quartermaster.join.salts", "8"))
    ls = li.withColumn("__salt", F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey",
                                                   "unit_cost"), F.lit(salts)))
    os_ = o.withColumn("__osalt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return (ls.join(os_, (ls["l_orderkey"] == os_["o_orderkey"]) & (ls["__salt"] == os_["__osalt"]))
              .drop("__salt", "__osalt"))


def inventory_panel(products: DataFrame, start: _dt.date = SNAPSHOT_START,
                    weeks: int = SNAPSHOT_WEEKS, warehouses=WAREHOUSES) -> DataFrame:
    """Weekly product x warehouse stock panel of the conformed star.

    Generated per product row with two ``posexplode``s over literal arrays, so it
    is a narrow transformation of ``products`` (no join, no shuffle).
    """
    wh = F.array(*[F.lit(w) for w in warehouses])
    p = products
    if "w" not in p.columns:          # else a row per product and week is given
        p = p.withColumn("w", F.explode(F.sequence(F.lit(0), F.lit(weeks - 1))))
    x = p.select("product_id", "w", F.posexplode(wh).alias("wi", "warehouse"))
    on_hand = F.pmod(F.col("product_id") * 7919 + F.col("wi") * 104729 + F.col("w") * 1299709,
                     F.lit(501)).cast("int")
    reorder = (F.lit(50) + F.lit(50) * F.pmod(F.col("product_id"), F.lit(3))).cast("int")
    return (x.select(F.date_add(F.lit(start), F.col("w") * 7).alias("snapshot_date"),
                     "product_id", "warehouse",
                     on_hand.alias("quantity_on_hand"),
                     reorder.alias("reorder_point"))
             .withColumn("quantity_on_order",
                         F.when(F.col("quantity_on_hand") < F.col("reorder_point"),
                                F.col("reorder_point") + F.col("quantity_on_hand"))
                          .otherwise(F.lit(0)).cast("int")))


class Deferred:
    """A table that is built on first use, once, whichever thread asks first."""

    def __init__(self, build: Callable[[], DataFrame]):
        self._build, self._lock, self._df = build, threading.Lock(), None

    def get(self) -> DataFrame:
        with self._lock:
            if self._df is None:
                self._df = self._build()
            return self._df


@dataclass
class Star:
    """The four conformed tables plus memoised size checks for their dims.

    A table may be ``Deferred``: reading the attribute builds it. A written star
    so writes each table when the first query needs it.
    """

    spark: SparkSession
    suppliers: DataFrame | Deferred
    products: DataFrame | Deferred
    purchase_orders: DataFrame | Deferred
    inventory_snapshots: DataFrame | Deferred
    source: str = ""
    path: str | None = None           # folder of the written star (None: lazy views)
    months: Callable[[str, str], DataFrame] | None = None     # order lines of whole months, where stored by month
    laid: Callable[[Callable], DataFrame] | None = None       # order lines whose rows a function deals out early
    panel: Callable[[], DataFrame] | None = None              # the inventory, a snapshot date a partition
    _bounded: dict = field(default_factory=dict)

    def __getattribute__(self, name: str):
        value = object.__getattribute__(self, name)
        return value.get() if isinstance(value, Deferred) else value

    def tables(self) -> dict[str, DataFrame]:
        return {"suppliers": self.suppliers, "products": self.products,
                "purchase_orders": self.purchase_orders,
                "inventory_snapshots": self.inventory_snapshots}

    def orders_of(self, first: str, last: str) -> DataFrame:
        """Order lines, of which those placed outside months ``first``..``last`` (YYYY-MM) may be missing.

        Only the folders of these months are opened where the star is stored by
        month; the caller's own predicate on the order date still decides.
        """
        return self.months(first, last) if self.months else self.purchase_orders

    def small(self, name: str) -> bool:
        """Checked once per star: may dimension ``name`` be broadcast?"""
        if name not in self._bounded:
            self._bounded[name] = is_bounded(getattr(self, name))
        return self._bounded[name]

    def small_frame(self, name: str, frame: DataFrame) -> bool:
        """May ``frame``, dimension ``name`` with columns joined to each row, be broadcast?

        The rows are the dimension's, the row width is that of the frame sent.
        """
        key = (name, tuple(frame.columns))
        if key not in self._bounded:
            self._bounded[key] = is_bounded(getattr(self, name), max_broadcast_rows(frame)) and is_bounded(frame)
        return self._bounded[key]

    def restrict(self, orders_where=None, inventory_where=None, months: tuple[str, str] | None = None) -> "Star":
        """The same star with row filters on its facts (dashboard date filters).

        Every result built on the returned star sees only the kept rows; the
        predicates reach the parquet scans. Dimensions and size checks are shared.
        ``months`` names the order months that ``orders_where`` can keep.
        """
        out = copy(self)
        if orders_where is not None:
            out.purchase_orders = Deferred(
                lambda: (self.orders_of(*months) if months else self.purchase_orders).where(orders_where))
            out.months = None
        if inventory_where is not None:
            out.inventory_snapshots = Deferred(lambda: self.inventory_snapshots.where(inventory_where))
        return out

    def register_views(self, prefix: str = "") -> None:
        for name, df in self.tables().items():
            df.createOrReplaceTempView(prefix + name)


_STARS: dict[tuple, Star] = {}
_STARS_LOCK = threading.Lock()


class _Spread:
    """Raw tables with ``lineitem`` and ``part`` spread over the cluster's cores
    when stored in fewer splits (see ``_spread``)."""

    def __init__(self, raw: Raw):
        self._raw = raw

    def __getattr__(self, name: str) -> DataFrame:
        df = getattr(self._raw, name)
        return _spread(df) if name in ("lineitem", "part") else df


def lazy_star(spark: SparkSession, sf_dir: str, spread: bool = False) -> Star:
    """The star as lazy views over the raw tables (nothing written).

    ``spread`` (used when the star is written) round-robins the large raw
    tables first if they are stored in fewer splits than there are cores.
    """
    raw = Raw(spark, sf_dir)
    src = _Spread(raw) if spread else raw
    return Star(spark=spark, suppliers=Deferred(lambda: conform_suppliers(raw)),
                products=Deferred(lambda: conform_products(src)),
                purchase_orders=Deferred(lambda: purchase_orders_from(src.lineitem, raw.orders, n_suppliers(raw))),
                inventory_snapshots=Deferred(lambda: inventory_panel(conform_products(src))), source=sf_dir,
                laid=lambda lay: purchase_orders_from(src.lineitem, raw.orders, n_suppliers(raw), lay),
                panel=lambda: _dealt_panel(src))


# Products of a task that writes their stock of one snapshot date.
PANEL_PRODUCTS = 250_000


def _dealt_panel(raw) -> DataFrame:
    """The inventory in partitions of one snapshot date and a bounded number of products each.

    Product and week are dealt out, whatever the files of ``part``; the warehouses
    and quantities that follow from them are generated where they are written.
    """
    products = raw.part.select(F.col("p_partkey").alias("product_id"))
    shares = -(-products.count() // PANEL_PRODUCTS) or 1
    weeks = products.withColumn("w", F.explode(F.sequence(F.lit(0), F.lit(SNAPSHOT_WEEKS - 1))))
    place = F.col("w") * shares + F.pmod(F.xxhash64("product_id"), F.lit(shares)).cast("int")
    return inventory_panel(weeks.repartitionById(SNAPSHOT_WEEKS * shares, place))


def dense_suppliers(spark: SparkSession, sf_dir: str) -> None:
    """Fails unless the supplier keys are 0..n-1, which ``product -> supplier`` needs.

    With other keys some supplier ids would have no row and the inner joins
    would drop their orders without a word.
    """
    k = Raw(spark, sf_dir).supplier.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("s_suppkey").alias("d"),
                                        F.min("s_suppkey").alias("lo"), F.max("s_suppkey").alias("hi")).first()
    if k.n and (k.d, k.lo, k.hi) != (k.n, 0, k.n - 1):
        raise ValueError(f"supplier keys must be 0..{k.n - 1}, each once; found {k.lo}..{k.hi}, {k.d} distinct of {k.n}")


def materialize_star(star: Star, path: str) -> Star:
    """A star whose tables are written as parquet under ``path`` on first use.

    This is the reference's own flow (build the tables, then query them) and
    cuts the conformance lineage: every later query scans real columns, so
    status and date predicates reach the parquet reader as pushed filters, and
    a lost executor costs a re-read of files instead of a recompute of the
    lineitem x orders join. Order lines are stored by order month and inventory
    by snapshot date, so a month window or the latest snapshot opens only its
    own folders. Order lines of a folder meet through an adaptive rebalance: small
    folders are few files, and a folder with a third of all rows is split. Of
    the inventory only products and weeks are dealt out, its rows are moved nowhere.
    """
    spark = star.spark

    def stored(name: str, write: Callable[[DataFrame, str], None]) -> DataFrame:
        folder = f"{path}/{name}"
        if not path_exists(spark, f"{folder}/_SUCCESS"):
            write(getattr(star, name), folder)
        return spark.read.parquet(folder)

    def plain(df: DataFrame, folder: str) -> None:
        df.write.mode("overwrite").parquet(folder)

    def months_met(df: DataFrame) -> DataFrame:
        return (df.withColumn(ORDER_MONTH, F.date_format("order_date", "yyyy-MM")).hint("rebalance", F.col(ORDER_MONTH))
                .sortWithinPartitions(ORDER_MONTH, "order_date"))

    def by_month(df: DataFrame, folder: str) -> None:
        ((star.laid(months_met) if star.laid else months_met(df))
         .write.mode("overwrite").partitionBy(ORDER_MONTH).parquet(folder))

    def by_snapshot(df: DataFrame, folder: str) -> None:
        panel = star.panel() if star.panel else df.hint("rebalance", F.col("snapshot_date"))
        (panel.sortWithinPartitions("snapshot_date")
         .write.mode("overwrite").partitionBy("snapshot_date").parquet(folder))

    def inventory() -> DataFrame:
        return stored("inventory_snapshots", by_snapshot).select(*star.inventory_snapshots.columns)

    orders = Deferred(lambda: stored("purchase_orders", by_month))
    return Star(spark=spark,
                suppliers=Deferred(lambda: stored("suppliers", plain)),
                products=Deferred(lambda: stored("products", plain)),
                purchase_orders=Deferred(lambda: orders.get().drop(ORDER_MONTH)),
                inventory_snapshots=Deferred(inventory),
                months=lambda first, last: (orders.get().where(F.col(ORDER_MONTH).between(first, last))
                                            .drop(ORDER_MONTH)),
                source=star.source, path=path)


def _spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows when the input has fewer splits than the cluster
    has cores (a small table stored as one row group); a large input already
    has thousands of splits and is left alone (no extra shuffle).

    Only called on plain file scans: their partition count comes from file
    listing alone, no job runs (on a plan with exchanges, asking for the RDD
    could make adaptive execution run shuffle stages).
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# Bumped whenever a conformance formula or the layout changes, so a persistent
# checkpoint folder never serves a star written by older code.
STAR_VERSION = 5
# The folder column of the stored order lines.
ORDER_MONTH = "stored_month"
# What the star is made of: a change of any of these files is another star.
STAR_INPUTS = ("region", "nation", "supplier", "part", "orders", "lineitem")


def star_path(spark: SparkSession, sf_dir: str) -> str:
    raw = Raw(spark, sf_dir)
    state = "|".join(f"{n}:{input_state(spark, raw.path(n))}" for n in STAR_INPUTS)
    tag = hashlib.sha1(f"{sf_dir.rstrip('/')}|{state}".encode()).hexdigest()[:16]
    return scratch_path(spark, f"star/v{STAR_VERSION}-{tag}")


def load_star(spark: SparkSession, sf_dir: str, materialize: bool | None = None) -> Star:
    """The conformed star of ``sf_dir``, memoised per session and state of its inputs.

    ``materialize`` (default: conf ``quartermaster.star.materialize``, true)
    writes each table once to the checkpoint dir, when it is first used, and
    reads it back. When an input file changes, the next call gives a new star.
    """
    if materialize is None:
        materialize = spark.conf.get("quartermaster.star.materialize", "true").lower() == "true"
    path = star_path(spark, sf_dir)
    key = (spark, path, materialize)
    with _STARS_LOCK:       # concurrent callers build a star once
        if key not in _STARS:
            if not path_exists(spark, f"{path}/_KEYS_CHECKED"):
                dense_suppliers(spark, sf_dir)
                spark.range(1).write.mode("overwrite").parquet(f"{path}/_KEYS_CHECKED")
            star = lazy_star(spark, sf_dir, spread=bool(materialize))
            _STARS[key] = materialize_star(star, path) if materialize else star
        return _STARS[key]
