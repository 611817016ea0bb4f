"""Seeded, distributed generators of the reference's four tables.

The reference builds Python lists row by row from one Mersenne-Twister stream.
Here every random draw is a counter-based hash of (seed, salt, row id), so each
row is a pure function of its id: generation runs on executors from
``spark.range``, any partitioning yields the same rows, and a table of any size
needs no driver memory. Distributions match the reference; the bytes do not
(a sequential PRNG stream cannot be split).
"""

from __future__ import annotations

import calendar
import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import MONEY
from ..operators.joins import is_bounded

# ---- fixed values (the reference's generator configuration) -----------------------
# region -> (countries, lead-time days range, reliability range)
REGION_CONFIG = (
    ("North America", ("US", "Canada", "Mexico"), (3, 14), (3.5, 5.0)),
    ("Europe", ("Germany", "UK", "France"), (3, 14), (3.5, 5.0)),
    ("Asia-Pacific", ("China", "Japan", "South Korea"), (14, 30), (2.5, 4.5)),
    ("South America", ("Brazil", "Argentina", "Chile"), (10, 25), (2.5, 4.5)),
    ("Africa", ("South Africa", "Nigeria", "Kenya"), (12, 28), (2.0, 4.0)),
)
# category -> (product names, unit cost range, weight kg range)
CATEGORY_CONFIG = (
    ("Electronics Components",
     ("Circuit Board A1", "Resistor Pack 1K", "LED Display Module", "Microcontroller Unit",
      "Capacitor Set", "Power Supply Unit", "Connector Cable Kit", "Sensor Array Module",
      "Memory Chip 8GB", "Transistor Pack"),
     (5.0, 150.0), (0.1, 5.0)),
    ("Raw Materials",
     ("Aluminum Sheet 4x8", "Copper Wire Spool", "Steel Rod Bundle", "Plastic Pellets 25kg",
      "Rubber Gasket Set", "Glass Panel 2x3", "Carbon Fiber Sheet", "Titanium Bar Stock",
      "Silicone Tubing 100ft", "Ceramic Substrate"),
     (10.0, 200.0), (1.0, 50.0)),
    ("Packaging",
     ("Cardboard Box Large", "Foam Insert Custom", "Shrink Wrap Roll", "Bubble Wrap 100ft",
      "Packing Tape Case", "Anti-Static Bag Pack", "Wooden Crate 3x3", "Label Roll 5000ct",
      "Pallet Standard 48x40", "Desiccant Pack Box"),
     (2.0, 50.0), (0.5, 15.0)),
)
# category -> order quantity range
QTY_RANGES = {"Electronics Components": (10, 200), "Raw Materials": (50, 500), "Packaging": (100, 500)}
# order month -> seasonal weight (Oct 2024 - Mar 2025)
MONTH_WEIGHTS = {10: 1.0, 11: 1.4, 12: 1.5, 1: 0.9, 2: 1.2, 3: 1.3}
ORDER_START, ORDER_END = _dt.date(2024, 10, 1), _dt.date(2025, 3, 31)
# status by cumulative probability: delivered .65, in_transit .20, delayed .10, cancelled .05
STATUS_CUTS = ((0.65, "delivered"), (0.85, "in_transit"), (0.95, "delayed"), (1.0, "cancelled"))
EXPECTED_OFFSET = (-2, 5)      # days added to the lead time
ACTUAL_OFFSET = (-3, 10)       # delivered: days after the expected date
PRICE_JITTER = (0.95, 1.05)
GEN_WAREHOUSES = ("Chicago", "Atlanta", "Seattle", "Dallas")
REORDER_POINTS = {"Electronics Components": 50, "Raw Materials": 100, "Packaging": 200}
SNAPSHOT_START_REF = _dt.date(2024, 11, 4)
WEEKS, N_LOW = 17, 5
LOW_MAX_SHARE, NORMAL_MIN_SHARE, ON_HAND_MAX = 0.6, 0.5, 500
SEED = 42


# ---- G5-G8: counter-based draws ------------------------------------------------------
def u(seed: int, salt: str, *cols) -> Column:
    """Uniform [0, 1) from a hash of (seed, salt, cols) - independent of partitioning.

    The first 13 hex digits of an MD5: 2^52 steps, so ``floor(u * n)`` reaches every
    one of n rows at any scale, and any SQL engine can repeat the draw.
    """
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(salt), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(2 ** 52)


def randint(lo, hi, draw: Column) -> Column:
    """Uniform integer in [lo, hi] (inclusive); bounds may be Columns."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return (lo_c + F.floor(draw * (hi_c - lo_c + 1))).cast("int")


def uniform(lo, hi, draw: Column, digits: int) -> Column:
    """Uniform real in [lo, hi] rounded to ``digits``."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return F.round(lo_c + draw * (hi_c - lo_c), digits)


def key(prefix: str, width: int, idx: Column) -> Column:
    """Zero-padded key ``PFX-000n`` (1-based)."""
    return F.format_string(f"{prefix}-%0{width}d", (idx + 1).cast("bigint"))


# ---- G1 -------------------------------------------------------------------------------
def _region_rows():
    return [(i * 3 + j, region, country, lt[0], lt[1], rel[0], rel[1])
            for i, (region, countries, lt, rel) in enumerate(REGION_CONFIG)
            for j, country in enumerate(countries)]


def gen_suppliers(spark: SparkSession, n: int = 15, seed: int = SEED) -> DataFrame:
    """Suppliers cycling through the 15 (region, country) slots."""
    cfg = spark.createDataFrame(_region_rows(), "k int, region string, country string, lt_lo int, "
                                                "lt_hi int, rel_lo double, rel_hi double")
    ids = spark.range(n).withColumn("k", (F.col("id") % len(_region_rows())).cast("int"))
    return (ids.join(F.broadcast(cfg), "k")      # fixed 15-row configuration
               .select(key("SUP", 3, F.col("id")).alias("supplier_id"),
                       F.concat_ws(" ", F.col("country"), F.lit("Supply Co"),
                                   (F.col("id") + 1).cast("string")).alias("supplier_name"),
                       "region", "country",
                       randint(F.col("lt_lo"), F.col("lt_hi"), u(seed, "sup.lead", F.col("id")))
                       .alias("lead_time_days"),
                       uniform(F.col("rel_lo"), F.col("rel_hi"), u(seed, "sup.rel", F.col("id")), 1)
                       .alias("reliability_rating")))


# ---- G2 -------------------------------------------------------------------------------
def _category_rows():
    rows, k = [], 0
    for cat, names, cost, weight in CATEGORY_CONFIG:
        for name in names:
            rows.append((k, cat, name, cost[0], cost[1], weight[0], weight[1]))
            k += 1
    return rows


def gen_products(spark: SparkSession, suppliers: DataFrame, n: int = 30, seed: int = SEED) -> DataFrame:
    """Products cycling through the 30 (category, name) slots; uniform supplier."""
    slots = _category_rows()
    cfg = spark.createDataFrame(slots, "k int, category string, base_name string, c_lo double, "
                                       "c_hi double, w_lo double, w_hi double")
    n_sup = suppliers.agg(F.count(F.lit(1))).scalar()
    ids = spark.range(n).withColumn("k", (F.col("id") % len(slots)).cast("int"))
    name = F.when(F.col("id") < len(slots), F.col("base_name")) \
            .otherwise(F.concat_ws(" #", F.col("base_name"), (F.col("id") + 1).cast("string")))
    return (ids.join(F.broadcast(cfg), "k").withColumn("__n_sup", n_sup)
               .select(key("PROD", 3, F.col("id")).alias("product_id"),
                       name.alias("product_name"), "category",
                       uniform(F.col("c_lo"), F.col("c_hi"), u(seed, "prod.cost", F.col("id")), 2)
                       .cast(MONEY).alias("unit_cost"),
                       key("SUP", 3, F.floor(u(seed, "prod.sup", F.col("id")) * F.col("__n_sup")))
                       .alias("supplier_id"),
                       uniform(F.col("w_lo"), F.col("w_hi"), u(seed, "prod.weight", F.col("id")), 2)
                       .alias("weight_kg")))


# ---- G10: seasonal order date --------------------------------------------------------
def month_shares(start: _dt.date = ORDER_START, end: _dt.date = ORDER_END,
                 weights: dict = MONTH_WEIGHTS) -> list[tuple[_dt.date, int, float]]:
    """(first day, days in range, share) per month: weight x days, normalised.

    Accepting a uniform day with probability weight/max (the reference's
    rejection loop) gives exactly these month shares, uniform within a month.
    """
    out, d = [], _dt.date(start.year, start.month, 1)
    while d <= end:
        last = _dt.date(d.year, d.month, calendar.monthrange(d.year, d.month)[1])
        lo, hi = max(d, start), min(last, end)
        out.append((lo, (hi - lo).days + 1, weights.get(d.month, 1.0) * ((hi - lo).days + 1)))
        d = last + _dt.timedelta(days=1)
    tot = sum(w for _, _, w in out)
    return [(lo, n, w / tot) for lo, n, w in out]


def seasonal_date(draw_month: Column, draw_day: Column, start=ORDER_START, end=ORDER_END,
                  weights=MONTH_WEIGHTS) -> Column:
    """Inverse CDF over the month shares, then a uniform day in the month."""
    shares = month_shares(start, end, weights)
    acc, expr_first, expr_days = 0.0, None, None
    for lo, ndays, share in shares:
        acc += share
        cond = draw_month < acc
        expr_first = F.when(cond, F.lit(lo)) if expr_first is None else expr_first.when(cond, F.lit(lo))
        expr_days = F.when(cond, F.lit(ndays)) if expr_days is None else expr_days.when(cond, F.lit(ndays))
    lo, ndays, _ = shares[-1]
    first = expr_first.otherwise(F.lit(lo))
    days = expr_days.otherwise(F.lit(ndays))
    return F.date_add(first, F.floor(draw_day * days).cast("int"))


# ---- G3 -------------------------------------------------------------------------------
def _status(draw: Column) -> Column:
    expr = None
    for cut, name in STATUS_CUTS[:-1]:
        expr = F.when(draw < cut, F.lit(name)) if expr is None else expr.when(draw < cut, F.lit(name))
    return expr.otherwise(F.lit(STATUS_CUTS[-1][1]))


def _lookup(mapping: dict, col: Column) -> Column:
    return F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])[col]


def gen_purchase_orders(spark: SparkSession, products: DataFrame, suppliers: DataFrame,
                        n: int = 800, seed: int = SEED, start=ORDER_START, end=ORDER_END,
                        month_weights=MONTH_WEIGHTS) -> DataFrame:
    """Orders: seasonal date, uniform product, its supplier's lead time, status mix."""
    n_prod = products.agg(F.count(F.lit(1))).scalar()
    rid = F.col("id")
    o = (spark.range(n).withColumn("__n_prod", n_prod)
         .select(rid, key("PO", 5, rid).alias("order_id"),
                 key("PROD", 3, F.floor(u(seed, "po.prod", rid) * F.col("__n_prod"))).alias("product_id"),
                 seasonal_date(u(seed, "po.month", rid), u(seed, "po.day", rid), start, end,
                               month_weights).alias("order_date")))
    p = products.select("product_id", "supplier_id", "category",
                        F.col("unit_cost").alias("__std_cost"))
    s = suppliers.select("supplier_id", "lead_time_days")
    o = o.join(F.broadcast(p) if is_bounded(p) else p, "product_id")
    o = o.join(F.broadcast(s) if is_bounded(s) else s, "supplier_id")
    qlo = _lookup({k: v[0] for k, v in QTY_RANGES.items()}, F.col("category"))
    qhi = _lookup({k: v[1] for k, v in QTY_RANGES.items()}, F.col("category"))
    expected = F.date_add(F.col("order_date"), F.col("lead_time_days")
                          + randint(*EXPECTED_OFFSET, u(seed, "po.eta", rid)))
    status = _status(u(seed, "po.status", rid))
    jitter = F.lit(PRICE_JITTER[0]) + u(seed, "po.price", rid) * (PRICE_JITTER[1] - PRICE_JITTER[0])
    o = o.withColumns({"expected_delivery_date": expected, "status": status})
    actual = F.when(F.col("status") == "delivered",
                    F.date_add(F.col("expected_delivery_date"),
                               randint(*ACTUAL_OFFSET, u(seed, "po.actual", rid))))
    return o.select("order_id", "product_id", "supplier_id", "order_date", "expected_delivery_date",
                    actual.alias("actual_delivery_date"),
                    randint(qlo, qhi, u(seed, "po.qty", rid)).alias("quantity"),
                    F.round(F.col("__std_cost").cast("double") * jitter, 2).cast(MONEY).alias("unit_cost"),
                    "status")


# ---- G4 -------------------------------------------------------------------------------
def pick_low_stock(products: DataFrame, k: int = N_LOW, seed: int = SEED) -> DataFrame:
    """K products without replacement (smallest hash rank; top-k, not a sort)."""
    return (products.select("product_id", u(seed, "inv.low", F.col("product_id")).alias("__r"))
                    .orderBy("__r", "product_id").limit(k).select("product_id"))


def gen_inventory(spark: SparkSession, products: DataFrame, start=SNAPSHOT_START_REF, weeks: int = WEEKS,
                  warehouses=GEN_WAREHOUSES, n_low: int = N_LOW, seed: int = SEED,
                  reorder_points: dict = REORDER_POINTS, default_reorder: int = 100) -> DataFrame:
    """Weekly product x warehouse panel; ``n_low`` products are always below
    their reorder point (G18-G22). Narrow except the k-row low-stock pick."""
    low = pick_low_stock(products, n_low, seed).withColumn("__low", F.lit(True))
    rp = F.coalesce(_lookup(reorder_points, F.col("category")), F.lit(default_reorder))
    p = (products.select("product_id", rp.alias("reorder_point"))
                 .join(F.broadcast(low), "product_id", "left"))      # k rows
    wh = F.array(*[F.lit(w) for w in warehouses])
    x = (p.select("*", F.posexplode(wh).alias("wi", "warehouse"))
          .select("*", F.explode(F.sequence(F.lit(0), F.lit(weeks - 1))).alias("w")))
    cell = [F.col("product_id"), F.col("wi"), F.col("w")]
    is_low = F.coalesce(F.col("__low"), F.lit(False))
    on_hand = F.when(is_low, randint(0, F.floor(F.col("reorder_point") * LOW_MAX_SHARE),
                                     u(seed, "inv.low_qty", *cell))) \
               .otherwise(randint(F.floor(F.col("reorder_point") * NORMAL_MIN_SHARE), ON_HAND_MAX,
                                  u(seed, "inv.qty", *cell)))
    x = x.withColumn("quantity_on_hand", on_hand.cast("int"))
    on_order = F.when(F.col("quantity_on_hand") < F.col("reorder_point"),
                      randint(F.col("reorder_point"), F.col("reorder_point") * 3,
                              u(seed, "inv.order", *cell))).otherwise(F.lit(0))
    return x.select(F.date_add(F.lit(start), F.col("w") * 7).alias("snapshot_date"),
                    "product_id", "warehouse", "quantity_on_hand",
                    F.col("reorder_point").cast("int").alias("reorder_point"),
                    on_order.cast("int").alias("quantity_on_order"))


def build_all(spark: SparkSession, scale: float = 1.0, seed: int = SEED) -> dict[str, DataFrame]:
    """G1-G4 at ``scale`` x the reference sizes (15 / 30 / 800 / 17 weeks; 5 low products)."""
    s = gen_suppliers(spark, max(1, round(15 * scale)), seed)
    p = gen_products(spark, s, max(1, round(30 * scale)), seed)
    o = gen_purchase_orders(spark, p, s, max(1, round(800 * scale)), seed)
    i = gen_inventory(spark, p, n_low=max(1, round(N_LOW * scale)), seed=seed)
    return {"suppliers": s, "products": p, "purchase_orders": o, "inventory_snapshots": i}
