"""Quality rules as a short-circuit cascade.

Every rule is a small test of one text. ``plan`` runs all of them over a bounded
sample, measures what each costs and how often it rejects, and orders them by
rejections per unit of cost, so the cheap and sharp ones come first; ``keep``
then stops at a text's first rejection. The verdict is the conjunction of the
rules, so it doesn't depend on the order; only the time does.

Defined cases: a null text is an empty text; an empty text has no words and is
rejected as too short; an empty table gives an empty result and the declared
order of the rules; repeated rows are judged row by row; extra columns stay
where the input frame is filtered and are ignored where statistics are returned.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 1000          # rows that the cost and selectivity estimates are made on
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = UPPER + UPPER.lower()


class Text:
    """One text with its statistics, each computed on first use only."""

    def __init__(self, raw: str | None):
        self.raw = raw or ""

    @cached_property
    def data(self) -> bytes:
        return self.raw.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()                       # splits on the six ASCII white-space characters

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.raw) - sum(map(self.raw.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.raw.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.data.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_upper(self) -> int:
        return len(self.data) - len(self.data.translate(None, UPPER))

    @cached_property
    def n_letters(self) -> int:
        return len(self.data) - len(self.data.translate(None, LETTERS))

    @cached_property
    def n_repeat_words(self) -> int:
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        if len(set(windows)) == len(windows):
            return 0
        counts, covered, upto = Counter(windows), 0, 0
        for i, x in enumerate(windows):
            if counts[x] > 1:
                covered += i + 3 - max(i, upto)
                upto = i + 3
        return covered


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


BASE_RULES = (
    Rule("too_few_words", lambda t: t.n_words < 50),
    Rule("repeated_words", lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
)
METHOD_RULES = (
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("upper_case", lambda t: 2 * t.n_upper > t.n_letters),
    Rule("duplicate_lines", lambda t: 2 * t.n_dup_lines > len(t.lines)),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 40 * t.n_words),
)
RULES = BASE_RULES + METHOD_RULES


def estimates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES,
              sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Per rule: its cost (ns a text), its share of rejections, and their ratio, on the sample.

    The sample is the ``sample_rows`` ids that hash lowest; it only steers the order.
    """
    ids = (docs.select(F.col(id_col).alias("id")).where("id is not null").distinct()
           .orderBy(F.xxhash64("id"), "id").limit(sample_rows))
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, rejected, n = Counter(), Counter(), 0
        for batch in batches:
            for raw in batch.column("text").to_pylist():
                n += 1
                for rule in rules:
                    text = Text(raw)                    # nothing shared: each rule at its full cost
                    began = time.perf_counter_ns()
                    rejected[rule.name] += bool(rule.rejects(text))
                    cost[rule.name] += time.perf_counter_ns() - began
        if n:
            names = [r.name for r in rules]
            yield pa.RecordBatch.from_pydict({"rule": names, "cost": [cost[x] for x in names],
                                              "rejected": [rejected[x] for x in names], "n": [n] * len(names)})

    sums = (sample.select("text").mapInArrow(measure, "rule string, cost bigint, rejected bigint, n bigint")
            .groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("cost", "rejected", "n")]).collect())
    return [{"rule": r.rule, "cost_ns": r.cost / r.n, "rejected": r.rejected / r.n,
             "gain": r.rejected / max(r.cost, 1)} for r in sums]


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES,
         sample_rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """The rules by rejection per cost, best first; among rules that reject nothing, cheapest first."""
    found = {e["rule"]: e for e in estimates(docs, id_col, text_col, rules, sample_rows)}
    if not found:
        return tuple(rules)
    return tuple(sorted(rules, key=lambda r: (-found[r.name]["gain"], found[r.name]["cost_ns"])))


def kept(text: Text, cascade: tuple[Rule, ...]) -> bool:
    """Whether no rule rejects; stops at the first that does."""
    return not any(rule.rejects(text) for rule in cascade)


def keep(text: Column, cascade: tuple[Rule, ...]) -> Column:
    """Boolean column for a filter: true where the cascade rejects nothing."""

    @F.pandas_udf("boolean")
    def verdict(texts: pd.Series) -> pd.Series:
        return pd.Series([kept(Text(t), cascade) for t in texts], dtype=bool)

    return verdict(text)


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, cascade: tuple[Rule, ...], id_col: str = "doc_id",
          text_col: str = "text", base=BASE_RULES) -> DataFrame:
    """(id, the statistics of STATS, base_failed, kept) of every row."""
    # The base verdict comes from the returned statistics; the others short-circuit behind it.
    rest = tuple(r for r in cascade if r not in base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Text(t) for t in batch.column("text").to_pylist()]
            failed, ok, stats = [], [], {s: [] for s in STATS}
            while texts:                                # frees each text's words at once
                t = texts.pop()
                for s in STATS:
                    stats[s].append(getattr(t, s))
                failed.append(any(r.rejects(t) for r in base))
                ok.append(not failed[-1] and kept(t, rest))
            cols = [pa.array(stats[s][::-1], pa.int64()) for s in STATS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *cols, pa.array(failed[::-1], pa.bool_()), pa.array(ok[::-1], pa.bool_())],
                ["id", *STATS, "base_failed", "kept"])

    base_df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base_df.schema["id"].dataType.simpleString()
    out = base_df.mapInArrow(run, f"id {kind}, " + ", ".join(f"{s} bigint" for s in STATS)
                             + ", base_failed boolean, kept boolean")
    return out.withColumnRenamed("id", id_col)
