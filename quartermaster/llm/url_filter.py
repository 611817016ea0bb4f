"""URL filter by a weighted vocabulary: strict and soft terms, Aho-Corasick counts.

One automaton over all terms scans each lower-cased URL once. A hit counts only
at word boundaries (no ASCII letter or digit next to it), so "essex" holds no
"sex". One strict term, or ``soft_limit`` different soft terms, rejects the URL.
Explicit host and path rules come before the vocabulary: the longest that fits
decides.

Defined cases: a null URL has an empty host and path, fits no rule, holds no
term and is allowed; a URL without ``://`` has an empty host and path but its
text is still scanned for terms; repeated rows are judged row by row; extra
columns are ignored. The vocabulary and the rules are small parameters; they
travel with the task, so nothing is broadcast that grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRICT = ("casino", "casinos", "porn", "porno", "xxx", "viagra", "cialis", "escort", "escorts",
          "gambling", "blackjack", "poker", "roulette", "betting", "sportsbook", "pills", "warez",
          "hentai", "camgirl", "camgirls", "payday", "malware", "phishing")
SOFT = ("free", "win", "winner", "cheap", "bet", "bets", "bonus", "jackpot", "ads", "ad", "track",
        "tracker", "tracking", "click", "deal", "deals", "discount", "loan", "loans", "promo",
        "adult", "sex", "sexy", "drugs", "pharmacy", "slots", "lottery", "prize", "spam", "crack",
        "cracked", "torrent", "hot", "dating", "replica", "cash", "coupon", "coupons", "popup")
SOFT_LIMIT = 2
# (rule, verdict), a rule being host/path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
         ("org/fr/", "allow"))


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else ''."""
    raw = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(raw, upper, upper.lower()), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; '' where there is no host part."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host_: Column, path_: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    longest_first = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in reversed(longest_first):
        h, _, p = rule.partition("/")
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith("/" + p)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _counter(strict: tuple[str, ...], soft: tuple[str, ...]):
    """A function from batches of (…, url) to the same batches with n_strict and n_soft."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = ahocorasick.Automaton()
        for term in soft:
            auto.add_word(term, (term, False))
        for term in strict:
            auto.add_word(term, (term, True))
        if len(auto):
            auto.make_automaton()
        for batch in batches:
            n_strict, n_soft = [], []
            for url in batch.column("url").to_pylist():
                hits, low = {}, (url or "").lower()
                for end, (term, is_strict) in (auto.iter(low) if len(auto) else ()):
                    start = end - len(term) + 1
                    if not (_word(low, start - 1) or _word(low, end + 1)):
                        hits[term] = is_strict
                n_strict.append(sum(hits.values()))
                n_soft.append(len(hits) - n_strict[-1])
            columns = [*batch.columns, pa.array(n_strict, pa.int64()), pa.array(n_soft, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "n_strict", "n_soft"])

    return count


def _word(s: str, i: int) -> bool:
    return 0 <= i < len(s) and s[i].isascii() and s[i].isalnum()


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", strict=STRICT, soft=SOFT,
          soft_limit: int = SOFT_LIMIT, rules=RULES) -> DataFrame:
    """(id, url, host, path, rule, verdict, n_strict, n_soft): one row per input row.

    ``verdict`` is the fitting rule's, else "block" with one strict term or
    ``soft_limit`` distinct soft terms, else "allow".
    """
    u = F.col(url_col)
    base = pages.select(F.col(id_col).alias("id"), u.alias("url"))
    base = base.select("*", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    counted = base.mapInArrow(_counter(tuple(strict), tuple(soft)), _schema(base))
    by_terms = F.when((F.col("n_strict") >= 1) | (F.col("n_soft") >= soft_limit), "block").otherwise("allow")
    fit = fitting_rule(F.col("host"), F.col("path"), rules)
    return (counted.withColumn("fit", fit)
            .select(F.col("id").alias(id_col), F.col("url").alias(url_col), "host", "path",
                    F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", by_terms).alias("verdict"),
                    "n_strict", "n_soft"))


def _schema(base: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in base.dtypes) + ", n_strict bigint, n_soft bigint"
