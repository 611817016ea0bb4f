"""Secret scan with a trigram inverted index (DataFrame functions only).

From each rule's regex a Boolean query over trigrams is derived: an OR of ANDs of
trigrams that every match must contain. The index holds the postings
(trigram, id) of just those trigrams; a rule's candidates are the documents in
the intersection of one AND's postings. Only candidates are verified by the
regex. A rule without a mandatory trigram (a run of hex digits) scans every text.

Matches of a rule are leftmost and non-overlapping; offsets are code points, end
exclusive. A match fails if the rule's group is too short; it is dropped after it
has consumed its characters.

Defined cases: a null or empty text has no span; empty tables give empty results;
repeated rows are scanned row by row and null or repeated ids only widen the
candidates, as each row's own text is verified; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as rc
from re import _parser as rp

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import is_bounded
from .common import materialise

BROADCAST_IDS = 1_000_000       # candidate ids up to this number (and the library's bytes) are broadcast, more are shuffled
MAX_STRINGS, MAX_CONJUNCTS, SMALL_CLASS = 64, 64, 6


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str                # the same text is valid for Spark's regex functions and for ``re``
    group: int = 0              # the group whose length decides
    least: int = 1              # its least length in characters


# Fixed values. The first three are the base kinds, in their order.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # a run shorter than 24 fails, and a run has no match inside it, so the bound may stand in the regex
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[sr]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    # the whole key: through the END line, or to the end of a text that has none
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY(?: BLOCK)?-----"
                        r"(?:[\s\S]*?-----END [A-Z ]{0,20}PRIVATE KEY(?: BLOCK)?-----|[\s\S]*)"),
)
RULES = BASE + MORE


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """An OR of ANDs of lower-case trigrams that the text of any match contains; None: no such query."""
    exact, query = _analyse(rp.parse(pattern))
    query = _and(query, _strings(exact)) if exact is not None else query
    return None if frozenset() in query else sorted(query, key=sorted)


TRUE = {frozenset()}


def _strings(strings: set[str]) -> set[frozenset[str]]:
    """The query of "one of these strings": a string under three characters says nothing."""
    return _minimal({frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings})


def _minimal(query: set[frozenset[str]]) -> set[frozenset[str]]:
    return {a for a in query if not any(b < a for b in query)}


def _and(a: set[frozenset[str]], b: set[frozenset[str]]) -> set[frozenset[str]]:
    if len(a) * len(b) > MAX_CONJUNCTS:
        return a if len(a) <= len(b) else b          # weaker, still necessary
    return _minimal({x | y for x, y in product(a, b)})


def _analyse(tree) -> tuple[set[str] | None, set[frozenset[str]]]:
    """(all strings it matches, if few; else None), and a necessary query of what else it holds."""
    run, query, whole = {""}, TRUE, True
    for op, arg in tree:
        exact, more = _item(op, arg)
        if exact is not None and len(run) * len(exact) <= MAX_STRINGS:
            run = {a + b for a, b in product(run, exact)}
            continue
        query, whole = _and(query, _strings(run)), False
        query = _and(query, more if exact is None else TRUE)
        run = {""} if exact is None else exact
    return (run, query) if whole else (None, _and(query, _strings(run)))


def _item(op, arg) -> tuple[set[str] | None, set[frozenset[str]]]:
    if op is rc.LITERAL:
        return {chr(arg).lower()}, TRUE
    if op is rc.IN and all(o is rc.LITERAL for o, _ in arg) and len(arg) <= SMALL_CLASS:
        return {chr(c).lower() for _, c in arg}, TRUE
    if op is rc.SUBPATTERN:
        return _analyse(arg[-1])
    if op is rc.BRANCH:
        parts = [_analyse(x) for x in arg[1]]
        if all(e is not None for e, _ in parts):
            return set().union(*(e for e, _ in parts)), TRUE
        either = set().union(*(_and(q, _strings(e)) if e is not None else q for e, q in parts))
        return None, _minimal(either)
    if op is rc.MAX_REPEAT:
        least, most, inner = arg
        exact, more = _analyse(inner)
        if exact is not None and most == 1:
            return exact | ({""} if least == 0 else set()), TRUE
        if least == 0:
            return None, TRUE
        return None, more if exact is None else _strings(exact)
    if op is rc.AT:
        return {""}, TRUE
    return None, TRUE


def _id(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))


def index(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The postings (trigram, id) of every trigram that a rule's query has, over whole texts."""
    grams = sorted({g for r in rules for c in trigram_query(r.pattern) or [] for g in c})
    low = _id(docs, id_col, text_col).select("id", F.lower("text").alias("low"))
    if not grams:
        return low.select("id", F.lit("").alias("trigram")).limit(0)
    there = F.array_distinct(F.regexp_extract_all("low", F.lit(_any_of(grams)), F.lit(1)))
    return low.select("id", F.explode(there).alias("trigram"))


def _any_of(grams: list[str]) -> str:
    """A regex that finds each of the trigrams at every position, overlapping ones too, in one pass."""
    firsts = sorted({g[0] for g in grams})
    tails = {c: "|".join(re.escape(g[1:]) for g in grams if g[0] == c) for c in firsts}
    some = ["".join(map(re.escape, sorted({g[k] for g in grams}))) for k in range(3)]       # most positions end here
    return (f"(?=[{some[0]}][{some[1]}][{some[2]}])"
            f"(?=({'|'.join(f'{re.escape(c)}(?:{tails[c]})' for c in firsts)}))")


def candidates(postings: DataFrame, rules=RULES) -> DataFrame:
    """(id, one Boolean column per indexed rule): the ids in the intersections, by rule."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    grams = sorted({g for q in queries.values() for c in q or [] for g in c})
    has = postings.groupBy("id").agg(*[F.max(F.col("trigram") == g).alias(f"g{i}") for i, g in enumerate(grams)])
    col = {g: F.col(f"g{i}") for i, g in enumerate(grams)}
    each = {k: reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [col[g] for g in sorted(c)]) for c in q])
            for k, q in queries.items() if q}
    out = has.select("id", *[F.coalesce(c, F.lit(False)).alias(f"may_{k}") for k, c in each.items()])
    return out.where(reduce(lambda a, b: a | b, [F.col(f"may_{k}") for k in each]))


def _let(value: Column, body) -> Column:
    """``body`` of the value, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _chunks(values: Column, body) -> Column:
    """``body`` of each of about sqrt(n) runs of an array of n, in order."""
    step = F.greatest(F.ceil(F.sqrt(F.size(values))).cast("int"), F.lit(1))
    starts = F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), step)
    return F.transform(starts, lambda at: body(F.slice(values, at + 1, step)))


def _running(values: Column, merge) -> Column:
    """By value of an int array, what ``merge`` makes of 0 and all values before it.

    An array that grows by one is copied each time. So it is made in runs, and their
    totals go on; a text with n matches costs n * sqrt(n) short steps at most.
    """

    def along(run: Column) -> Column:
        empty = F.struct(F.lit(0).alias("all"), F.array().cast("array<int>").alias("before"))
        return F.aggregate(run, empty, lambda acc, v: F.struct(
            merge(acc["all"], v).alias("all"), F.concat(acc["before"], F.array(acc["all"])).alias("before")))

    def whole(runs: Column) -> Column:
        before = along(F.transform(runs, lambda r: r["all"]))["before"]
        return F.flatten(F.zip_with(runs, before, lambda r, b: F.transform(r["before"], lambda v: merge(b, v))))

    return _let(values, lambda v: _let(_chunks(v, along), whole))


SPAN = "array<struct<start:int,end:int,rank:int,kind:string>>"


def spans_of(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's spans in a text, in order.

    The text between the matches is ``split``'s; running lengths give the offsets.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    groups = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    parts = F.transform(
        F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), matches.alias("hit"), groups.alias("group")),
        lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.coalesce(F.length(x["hit"]), F.lit(0)).alias("hit"),
                           (x["hit"].isNotNull() & (F.length(x["group"]) >= rule.least)).alias("good")))

    def spans(p: Column) -> Column:
        before = _running(F.transform(p, lambda x: x["gap"] + x["hit"]), lambda a, b: a + b)
        every = F.zip_with(p, before, lambda x, at: F.struct(
            (at + x["gap"]).alias("start"), (at + x["gap"] + x["hit"]).alias("end"), x["good"].alias("good")))
        return F.transform(F.filter(every, lambda x: x["good"]), lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind")))

    return _let(parts, spans)


def scan(spark: SparkSession, docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text",
         keep_rows: bool = False, spans_col: str = "spans") -> DataFrame:
    """Every row's id and ``spans``: array of (start, end, rank, kind) by start, then rule order.

    With ``keep_rows`` the input's columns stay and ``spans_col`` is added.
    """
    found = materialise(spark, candidates(index(docs, rules, id_col, text_col), rules), "secret-candidates")
    small = is_bounded(found, BROADCAST_IDS) and is_bounded(found)      # rows, and bytes
    found = found.withColumnRenamed("id", "__id")
    rows = docs.join(F.broadcast(found) if small else found, docs[id_col].eqNullSafe(found["__id"]), "left")
    text = F.coalesce(docs[text_col], F.lit(""))
    none = F.array().cast(SPAN)
    parts = []
    for rank, rule in enumerate(rules):
        may = F.col(f"may_{rule.kind}") if f"may_{rule.kind}" in found.columns else text.rlike(rule.pattern)
        parts.append(F.when(F.coalesce(may, F.lit(False)), spans_of(text, rule, rank)).otherwise(none))
    spans = F.array_sort(F.concat(*parts)).alias(spans_col)
    if keep_rows:
        return rows.select(*[docs[c] for c in docs.columns], spans)
    return rows.select(docs[id_col], spans)


def joined(spans: Column) -> Column:
    """kind:start:end of the spans in their order, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch covered by spans replaced by ``mark``."""
    def pieces(found: Column) -> Column:
        ends = F.transform(found, lambda s: s["end"])
        every = F.zip_with(found, _running(ends, F.greatest), lambda s, at: F.struct(at.alias("from"), s["start"].alias("to")))
        kept = F.filter(every, lambda x: x["to"] >= x["from"])        # others begin inside an earlier span
        return F.concat(F.array_join(_let(kept, lambda k: _chunks(k, run)), ""),
                        F.substring(text, F.array_max(ends) + 1, F.length(text)))

    def cut(whole: Column, at: Column, run_: Column) -> Column:
        return F.array_join(F.transform(run_, lambda x: F.concat(
            F.substring(whole, x["from"] - at + 1, x["to"] - x["from"]), F.lit(mark))), "")

    def run(items: Column) -> Column:
        """A run of pieces is cut from its own stretch of the text, as a cut walks from the beginning."""
        return _let(items, lambda r: _let(F.get(r, F.lit(0))["from"], lambda at: _let(
            F.substring(text, at + 1, F.get(r, F.size(r) - 1)["to"] - at), lambda whole: cut(whole, at, r))))

    return F.when(F.size(spans) > 0, _let(spans, pieces)).otherwise(text)


def redacted(spark: SparkSession, docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text",
             chars_col: str = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """The rows, with all their columns, every secret in the text replaced; its length follows."""
    found = scan(spark, docs, rules, id_col, text_col, keep_rows=True, spans_col="__spans")
    text = redact(F.col(text_col), F.col("__spans"), mark)
    new = {text_col: text}
    if chars_col in docs.columns:
        changed = F.length(text).cast(docs.schema[chars_col].dataType)
        new[chars_col] = F.when(F.size("__spans") > 0, changed).otherwise(F.col(chars_col))
    return found.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
