"""Result-set comparison and benchmark scoring (E1-E4), feedback (E5), alerts.

Comparisons are multiset differences (``exceptAll`` both ways), so they are
order-insensitive and distributed; every summary is an aggregation. A
benchmark run is a DataFrame of (run, question, category, score) rows.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

SCORES = ("Correct", "Partial", "Incorrect")


def _rounded(df: DataFrame, digits: int) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def diff_results(truth: DataFrame, candidate: DataFrame, digits: int = 6) -> DataFrame:
    """Rows of ``truth`` missing from ``candidate`` and rows only in ``candidate``.

    Columns are matched by name; doubles are rounded to ``digits`` first.
    Output: ``side`` ('missing' | 'extra') plus the truth's columns.
    """
    cols = sorted(truth.columns)
    t = _rounded(truth.select(*cols), digits)
    c = _rounded(candidate.select(*cols), digits)
    return (t.exceptAll(c).select(F.lit("missing").alias("side"), *cols)
            .unionByName(c.exceptAll(t).select(F.lit("extra").alias("side"), *cols)))


def score(question: str, category: str, truth: DataFrame, candidate: DataFrame,
          keys: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """One row scoring ``candidate`` against ``truth``.

    Correct: same multiset of rows. Partial: same columns and the same
    multiset of key values (right grain and members) but some values differ.
    Incorrect: otherwise (other columns, other grain or other members).

    One pass: both results are tagged, unioned and grouped by the full row
    (multiplicities per side), then by the key columns; every count is a sum
    over those groups. Each input is evaluated once and nothing is collected.
    """
    same_cols = sorted(truth.columns) == sorted(candidate.columns)
    if not same_cols:
        n_c = candidate.agg(F.count(F.lit(1))).scalar()
        return truth.agg(F.count(F.lit(1)).alias("truth_rows")).select(
            F.lit(question).alias("question"), F.lit(category).alias("category"),
            "truth_rows", n_c.alias("candidate_rows"),
            F.lit(None).cast("bigint").alias("missing_rows"),
            F.lit(None).cast("bigint").alias("extra_rows"), F.lit("Incorrect").alias("score"))
    cols = sorted(truth.columns)
    keys = list(keys)
    t = _rounded(truth.select(*cols), digits).withColumns({"__t": F.lit(1), "__c": F.lit(0)})
    c = _rounded(candidate.select(*cols), digits).withColumns({"__t": F.lit(0), "__c": F.lit(1)})
    rows = (t.unionByName(c).groupBy(*cols)
             .agg(F.sum("__t").alias("__nt"), F.sum("__c").alias("__nc")))
    by_key = (rows.groupBy(*keys).agg(F.sum("__nt").alias("__kt"), F.sum("__nc").alias("__kc"),
                                      F.sum(F.greatest(F.col("__nt") - F.col("__nc"), F.lit(0)))
                                      .alias("__miss"),
                                      F.sum(F.greatest(F.col("__nc") - F.col("__nt"), F.lit(0)))
                                      .alias("__extra")))
    tot = by_key.agg(F.coalesce(F.sum("__kt"), F.lit(0)).cast("bigint").alias("truth_rows"),
                     F.coalesce(F.sum("__kc"), F.lit(0)).cast("bigint").alias("candidate_rows"),
                     F.coalesce(F.sum("__miss"), F.lit(0)).cast("bigint").alias("missing_rows"),
                     F.coalesce(F.sum("__extra"), F.lit(0)).cast("bigint").alias("extra_rows"),
                     F.coalesce(F.sum(F.abs(F.col("__kt") - F.col("__kc"))), F.lit(0)).alias("__kd"))
    verdict = (F.when((F.col("missing_rows") == 0) & (F.col("extra_rows") == 0), "Correct")
                .when(F.col("__kd") == 0, "Partial").otherwise("Incorrect"))
    return tot.select(F.lit(question).alias("question"), F.lit(category).alias("category"),
                      "truth_rows", "candidate_rows", "missing_rows", "extra_rows",
                      verdict.alias("score"))


def score_run(run_id: int, cases: Sequence[tuple]) -> DataFrame:
    """E3 input: score every (question, category, truth, candidate, keys) case."""
    parts = [score(q, cat, t, c, keys).select(F.lit(run_id).alias("run_id"), "*")
             for q, cat, t, c, keys in cases]
    return reduce(DataFrame.unionByName, parts)


def run_summary(runs: DataFrame, target_pct: float = 80.0) -> DataFrame:
    """Per run and category - counts by score, accuracy %, pass mark.

    ``category='ALL'`` rows (from a roll-up of the per-category counts) carry
    the run's overall accuracy.
    """
    per = runs.groupBy("run_id", "category").agg(
        F.count(F.lit(1)).alias("questions"),
        *[F.count(F.when(F.col("score") == s, 1)).alias(s.lower()) for s in SCORES])
    rolled = (per.rollup("run_id", "category")
                 .agg(F.sum("questions").alias("questions"),
                      *[F.sum(s.lower()).alias(s.lower()) for s in SCORES])
                 .where(F.col("run_id").isNotNull())
                 .withColumn("category", F.coalesce(F.col("category"), F.lit("ALL"))))
    acc = F.round(F.try_divide(F.col("correct").cast("decimal(20,0)") * 100,
                               F.col("questions").cast("decimal(20,0)")), 1).cast("double")
    return (rolled.withColumn("accuracy_pct", acc)
                  .withColumn("meets_target", F.col("accuracy_pct") >= F.lit(target_pct)))


def compare_runs(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """Question-level change between two runs (full join on question)."""
    p = prev.select("question", F.col("score").alias("prev_score"))
    c = cur.select("question", "category", F.col("score").alias("cur_score"))
    rank = {"Incorrect": 0, "Partial": 1, "Correct": 2}
    r = F.create_map(*[x for k, v in rank.items() for x in (F.lit(k), F.lit(v))])
    change = (F.when(F.col("prev_score").isNull(), "new")
               .when(F.col("cur_score").isNull(), "dropped")
               .when(r[F.col("cur_score")] > r[F.col("prev_score")], "fixed")
               .when(r[F.col("cur_score")] < r[F.col("prev_score")], "regressed")
               .otherwise("same"))
    return (p.join(c, "question", "full")
             .withColumn("change", change)
             .withColumn("rerun", F.coalesce(F.col("prev_score") != "Correct", F.lit(True))))


def feedback_summary(fb: DataFrame, week_col: str = "asked_at") -> DataFrame:
    """E5: thumbs-down by week and failure pattern, with the unreviewed queue."""
    return (fb.withColumn("week", F.trunc(F.col(week_col), "week"))
              .groupBy("week", "pattern")
              .agg(F.count(F.lit(1)).alias("feedback"),
                   F.count(F.when(F.col("verdict") == "down", 1)).alias("thumbs_down"),
                   F.count(F.when((F.col("verdict") == "down") & ~F.col("reviewed"), 1))
                   .alias("unreviewed_down")))


def review_queue(fb: DataFrame) -> DataFrame:
    """E5: thumbs-down feedback not yet reviewed."""
    return fb.where((F.col("verdict") == "down") & ~F.col("reviewed"))


_OPS = {">": lambda v, t: v > t, ">=": lambda v, t: v >= t, "<": lambda v, t: v < t,
        "<=": lambda v, t: v <= t, "==": lambda v, t: v == t, "!=": lambda v, t: v != t}


def alerts(values: DataFrame, rules: DataFrame) -> DataFrame:
    """Evaluate threshold rules against measure values.

    ``values``: (measure, value[, scope...]); ``rules``: (measure, op, threshold).
    Rules are a small fixed list (broadcast). Returns every evaluated pair with
    a ``fired`` flag.
    """
    j = values.join(F.broadcast(rules), "measure")
    fired: Column = F.lit(None).cast("boolean")
    for op, fn in _OPS.items():
        fired = F.when(F.col("op") == op, fn(F.col("value"), F.col("threshold"))).otherwise(fired)
    return j.withColumn("fired", F.coalesce(fired, F.lit(False)))
