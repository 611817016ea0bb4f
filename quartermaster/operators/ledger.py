"""A run ledger, so that a run asks again only what failed or changed.

The ledger is a folder of Parquet entries, one folder a run, never rewritten. A
question's row is keyed by digests of its text, of the answer's text and of the
state of the input. A run carries over every question whose last row has the
same three keys and was Correct; only the others are planned and scored. An entry is
published by one rename, so a run that dies leaves no part of itself.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, publish
from .evaluate import score

ROW = ("run_id int, question string, category string, question_key string, answer_key string, state_key string, "
       "truth_rows bigint, candidate_rows bigint, missing_rows bigint, extra_rows bigint, score string, "
       "carried boolean, scored_in int")
KEYS = ("question_key", "answer_key", "state_key")


@dataclass(frozen=True)
class Asked:
    """A question of a run; ``build`` gives (truth, candidate) and is called only if it must be scored."""

    question: str
    category: str
    answer: str
    build: Callable[[], tuple[DataFrame, DataFrame]]
    keys: Sequence[str] = ()


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the ledger."""
    return spark.read.schema(ROW).parquet(f"{path}/run=*").select(*[c.split()[0] for c in ROW.split(", ")])


def record(spark: SparkSession, path: str, run_id: int, asked: Sequence[Asked], state: str) -> DataFrame:
    """Run ``run_id``'s rows: those carried over and those scored now. A recorded run is read back."""
    out = f"{path}/run={run_id}"
    if path_exists(spark, out):
        return spark.read.schema(ROW).parquet(out)
    keyed = {(_digest(a.question), _digest(a.answer), _digest(state)): a for a in asked}
    last = {}
    if run_id > 1 and path_exists(spark, path):
        # a row for each question asked, of the last run that had it: as many as questions
        wanted = F.concat_ws("/", *KEYS).isin(["/".join(k) for k in keyed])
        rows = (read(spark, path).where((F.col("run_id") < run_id) & wanted).groupBy(*KEYS)
                .agg(F.max_by(F.struct("*"), "run_id").alias("r")).collect())
        last = {tuple(r[k] for k in KEYS): r.r for r in rows if r.r.score == "Correct"}
    parts = []
    for key, a in keyed.items():
        if key in last:
            continue
        truth, candidate = a.build()
        parts.append(score(a.question, a.category, truth, candidate, a.keys).select(
            F.lit(run_id).alias("run_id"), "question", "category",
            *[F.lit(v).alias(k) for k, v in zip(KEYS, key)], "truth_rows", "candidate_rows", "missing_rows",
            "extra_rows", "score", F.lit(False).alias("carried"), F.lit(run_id).alias("scored_in")))
    carried = [tuple({**last[k].asDict(), "run_id": run_id, "carried": True}.values()) for k in keyed if k in last]
    if carried or not parts:
        parts.append(spark.createDataFrame(carried, ROW))
    staged = f"{path}/_staged-{uuid.uuid4().hex[:8]}"
    reduce(DataFrame.unionByName, parts).coalesce(1).write.parquet(staged)
    publish(spark, staged, out)
    return spark.read.schema(ROW).parquet(out)


def history(ledger: DataFrame) -> DataFrame:
    """Every question in every run, with the run that scored it."""
    return ledger.select("run_id", "question", "category", "score", "carried", "scored_in")
