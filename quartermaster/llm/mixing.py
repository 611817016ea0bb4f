"""Mixing sources to target weights by pivotal dependent rounding (DataFrame functions only).

Every document of a source gets the same expected number of copies, target over
source size. The whole part is taken; the fraction is a probability that has to
be rounded to 0 or 1. Pivotal rounding pairs two fractional documents and moves
mass between them, in a random direction with odds that keep both expectations,
until one is integral. Mass is counted in words, so a move never changes the
words that the source takes in expectation *or in sum*. Documents are dealt into
blocks of about ``BLOCK``; a block is folded from its largest document to its
smallest and leaves one fractional residual; the residuals are the documents of
the next level, so the rounds form a reduction tree of depth log_BLOCK(n) in
which a hot source is many small blocks. The root's residual is drawn freely, and the
words it gains or gives up are landed on the root block's other documents,
largest first, wherever one fits whole: a source's taken words miss its target
by less than one small document.

Equal rows are numbered, and a document of the rounding is an (id, number): they are
dealt into different blocks, and as any of them stands for any other, the numbers come
from a count. Draws are hashes of these, level and position, so reruns agree.

Defined cases: a null or empty text has size 0 and is taken 0 times; a null
source is a source of its own, last in the order; a source without words has
target 0; an empty table gives an empty result; repeated rows are rounded as
documents of their own; null ids are allowed; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, materialise

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK = 256
RUN = 4096                # numbers of equal rows that are made at once
SEED = 42


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sized: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, n, target) from (source, size): one row per source.

    Sources by code point, null last, weigh ``weights`` in turn and share all words.
    A target stops at ``cap`` times its source and the excess is reshared by weight.
    The fixed point is the water level at which the capped targets use up the total:
    with the sources in the order of cap/weight, the full ones come first. The
    windows here run over one row per source, never over documents.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.sum((F.col("size") > 0).cast("long")).alias("n"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    w = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), turn))
    w = w.withColumn("cap", (F.col("source_size") * cap).cast("double"))
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = W.partitionBy(F.lit(1))
    w = (w.withColumn("k", F.row_number().over(order))
         .withColumn("total", F.sum("source_size").over(everything).cast("double"))
         .withColumn("left", F.col("total") - F.coalesce(
             F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("open", F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))))
    level = F.col("left") / F.col("open")
    first_open = F.min(F.when(level * F.col("weight") < F.col("cap"), F.struct("k", level.alias("level")))).over(everything)
    w = w.withColumn("first_open", first_open)
    full = F.col("first_open").isNull() | (F.col("k") < F.col("first_open.k"))
    target = F.when(full, F.col("cap")).otherwise(F.col("first_open.level") * F.col("weight"))
    return w.select("source", "source_size", "n", target.alias("target"))


def _draw(*of: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11) / F.lit(float(1 << 53))


def _fold(docs: Column, id_type: str, level: int, seed: int) -> Column:
    """struct(live, id, size, mass, whole, i, done): a block's residual and its decided documents."""
    doc = f"id:{id_type},size:double,whole:bigint"
    null = lambda kind: F.lit(None).cast(kind)
    empty = F.struct(F.lit(False).alias("live"), null(id_type).alias("id"), null("double").alias("size"),
                     null("double").alias("mass"), null("bigint").alias("whole"), F.lit(0).alias("i"),
                     F.array().cast(f"array<struct<{doc},extra:int>>").alias("done"))

    def step(acc: Column, x: Column) -> Column:
        a, cap_a, b, cap_b = acc["mass"], acc["size"], x["mass"], x["size"]
        to_a, to_b = F.least(cap_a - a, b), F.least(a, cap_b - b)
        up = _draw(acc["id"], x["id"], acc["i"], F.lit(level), F.lit(seed)) * (to_a + to_b) < to_b
        a_full, b_gone = up & (cap_a - a <= b), up & (cap_a - a > b)
        a_gone, b_full = ~up & (a <= cap_b - b), ~up & (a > cap_b - b)
        # of the two, one is decided and the other goes on with what is left
        a_stays = b_gone | b_full
        mass = (F.when(a_full, b - (cap_a - a)).when(b_gone, F.least(a + b, cap_a))
                .when(a_gone, F.least(a + b, cap_b)).otherwise(a - (cap_b - b)))
        names = ("id", "size", "whole")
        stays = {k: F.when(a_stays, acc[k]).otherwise(x[k]).alias(k) for k in names}
        ends = {k: F.when(a_stays, x[k]).otherwise(acc[k]).alias(k) for k in names}
        decided = F.struct(*ends.values(), (a_full | b_full).cast("int").alias("extra"))
        paired = F.struct(F.lit(True).alias("live"), stays["id"], stays["size"], mass.alias("mass"),
                          stays["whole"], (acc["i"] + 1).alias("i"),
                          F.concat(acc["done"], F.array(decided)).alias("done"))
        first = F.struct(F.lit(True).alias("live"), x["id"].alias("id"), x["size"].alias("size"),
                         x["mass"].alias("mass"), x["whole"].alias("whole"), acc["i"].alias("i"),
                         acc["done"].alias("done"))
        return F.when(acc["live"], paired).otherwise(first)

    return F.aggregate(docs, empty, step)


def _land(f: Column, id_type: str, seed: int) -> Column:
    """The root block's decided documents, its residual drawn and its words landed on the others."""
    up = _draw(f["id"], F.lit("root"), F.lit(seed)) * f["size"] < f["mass"]
    owed = F.when(up, f["mass"] - f["size"]).otherwise(f["mass"])     # to add, or, below 0, to take back
    largest_first = F.array_sort(F.transform(f["done"], lambda d: F.struct(
        (-d["size"]).alias("order"), d["id"].alias("id"), d["size"].alias("size"),
        d["whole"].alias("whole"), d["extra"].alias("extra"))))
    empty = F.struct(owed.alias("owed"),
                     F.array().cast(f"array<struct<id:{id_type},size:double,whole:bigint,extra:int>>").alias("done"))

    def step(acc: Column, d: Column) -> Column:
        add = (acc["owed"] > 0) & (d["extra"] == 0) & (d["size"] <= acc["owed"])
        drop = (acc["owed"] < 0) & (d["extra"] == 1) & (d["size"] <= -acc["owed"])
        extra = F.when(add, 1).when(drop, 0).otherwise(d["extra"])
        left = F.when(add, acc["owed"] - d["size"]).when(drop, acc["owed"] + d["size"]).otherwise(acc["owed"])
        return F.struct(left.alias("owed"), F.concat(acc["done"], F.array(F.struct(
            d["id"].alias("id"), d["size"].alias("size"), d["whole"].alias("whole"), extra.alias("extra")))).alias("done"))

    residual = F.struct(f["id"].alias("id"), f["size"].alias("size"), f["whole"].alias("whole"),
                        up.cast("int").alias("extra"))
    return F.concat(F.aggregate(largest_first, empty, step)["done"], F.array(residual))


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows, ``id`` as struct(id, nth): equal ones are counted, and made again with their number from 0."""
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("equal"))
    runs = counted.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(equal - 1) div {RUN}"))))
    first = F.col("run") * RUN
    nth = F.explode(F.sequence(first, F.least(first + RUN, F.col("equal")) - 1))
    return (runs.withColumn("nth", nth).withColumn("id", F.struct("id", "nth"))
            .select(*rows.columns))


def round_copies(spark: SparkSession, docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(source, id, size, copies) from (source, id, size, copies_expected, n).

    ``n`` is the number of fractional documents of the source, or more.
    """
    whole = F.floor("expected").cast("long")
    frac = F.col("expected") - F.floor("expected")
    base = docs.select("source", "id", F.col("size").cast("double").alias("size"), whole.alias("whole"),
                       (frac * F.col("size")).alias("mass"),
                       F.ceil(F.col("n") / F.lit(float(block))).cast("long").alias("blocks"))
    is_open = (F.col("mass") > 0) & (F.col("mass") < F.col("size"))
    done = [base.where(~F.coalesce(is_open, F.lit(False))).select(
        "source", "id", "size", F.col("whole").alias("copies"))]
    level, rows = 0, _numbered(base.where(is_open))
    id_type = dict(rows.dtypes)["id"]
    while True:
        salt = F.xxhash64("id", "size", F.lit(seed), F.lit(level))
        dealt = rows.withColumn("block", F.pmod(salt, F.greatest("blocks", F.lit(1))))
        grouped = dealt.groupBy("source", "blocks", "block").agg(F.array_sort(F.collect_list(F.struct(
            (-F.col("size")).alias("order"), salt.alias("salt"), "id", "size", "mass", "whole"))).alias("docs"))
        fold = _fold(F.col("docs"), id_type, level, seed)
        folded = materialise(spark, grouped.select("source", "blocks", fold.alias("f")), f"mix-{level}")
        decided = F.when(F.col("blocks") <= 1, _land(F.col("f"), id_type, seed)).otherwise(F.col("f.done"))
        done.append(folded.select("source", F.explode(decided).alias("d")).select(
            "source", "d.id.id", "d.size", (F.col("d.whole") + F.col("d.extra")).alias("copies")))
        last = folded.agg(F.max("blocks")).first()[0] or 1
        rest = folded.select("source", "f.id", "f.size", "f.whole", "f.mass",
                             F.ceil(F.col("blocks") / F.lit(float(block))).cast("long").alias("next"), "blocks")
        if last <= 1:
            break
        rows = rest.where("blocks > 1").drop("blocks").withColumnRenamed("next", "blocks")
        level += 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def mix(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights=WEIGHTS, cap: int = CAP, block: int = BLOCK,
        seed: int = SEED) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken): one row per input row.

    ``taken`` is copies times size. It never exceeds ``cap`` times the size, as no
    target exceeds ``cap`` times its source.
    """
    sized = materialise(spark, docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                                           n_words(F.col(text_col)).alias("size")), "mix-sizes")
    per = materialise(spark, targets(sized, weights, cap), "mix-targets")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    expected = (F.when(F.col("target") >= F.col("source_size") * cap, F.lit(float(cap)))
                .when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    ready = (sized.join(per, same(sized, per)).select(
        sized["source"], "id", "size", expected.alias("expected"), "n"))
    copies = round_copies(spark, ready, block, seed)
    return (copies.join(per, same(copies, per)).select(
        F.col("id").alias(id_col), copies["source"].alias("source"), F.col("size").cast("long").alias("size"),
        "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken")))
