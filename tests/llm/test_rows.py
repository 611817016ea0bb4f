"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables, for every operator."""

import pytest
from pyspark.sql import functions as F

from quartermaster.llm import (decontaminate, html_extract, langid, licenses, mixing, quality_rules, ranker, secrets,
                               simhash, url_filter)

LONG = "alpha beta gamma delta. " * 40_000
DOCS = [(1, None, None, None), (2, "", "en", "a"), (3, "One two three four five six eight.", "en", "a"),
        (3, "One two three four five six eight.", "en", "a"), (None, "One two three four five six eight.", None, None),
        (4, LONG, "en", "a"), (5, "퟿ é 漢字 \x00\t\n", "xx", ""), (6, "!!! ### 12 ...", "xx", "b")]
EXTRA = ("id", "fp", "size", "text_digest", "n", "key", "spans", "__id2", "part", "range", "host", "kept", "x", "good")


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return df.select("*", *[F.lit("clash").alias(c) for c in EXTRA])


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return df.select("*", *[F.lit("clash").alias(c) for c in (*EXTRA, "text", "rule", "verdict", "n_soft")])


def benchmark(spark, rows=((1, "one two three four five six seven"), (2, None), (3, ""))):
    return spark.createDataFrame(list(rows), "item_id bigint, text string")


def labels(spark):
    return spark.createDataFrame([(3, 1), (4, 0), (6, None), (2, 0), (2, 1)], "doc_id bigint, quality int")


APPLY = {
    "mixing": lambda s, d: mixing.mix(s, d),
    "ranker": lambda s, d: ranker.score(d, ranker.train(d, labels(s))),
    "licenses": lambda s, d: licenses.scan(s, d),
    "langid": lambda s, d: langid.identify(d, langid.train(s, d)),
    "quality_rules": lambda s, d: quality_rules.judge(d, quality_rules.plan(d)),
    "quality_filter": lambda s, d: d.withColumn("ok", quality_rules.keep(F.col("text"), quality_rules.plan(d))),
    "simhash": lambda s, d: simhash.dedup(s, d),
    "secrets": lambda s, d: secrets.scan(s, d),
    "redacted": lambda s, d: secrets.redacted(s, d),
    "clean": lambda s, d: decontaminate.clean(s, d, benchmark(s, [])),
}


@pytest.mark.parametrize("name", APPLY)
def test_one_row_for_each_input_row(spark, name):
    got = APPLY[name](spark, frame(spark, DOCS)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in DOCS)
    assert APPLY[name](spark, frame(spark, [])).collect() == []


def test_decontamination_of_odd_rows(spark):
    rows = [*DOCS, (9, "zero ONE two, three four; five six seven!", None, None)]
    got = decontaminate.leaks(spark, frame(spark, rows), benchmark(spark)).collect()
    assert sorted((str(r.doc_id), r.item_id, r.n_equal) for r in got) == [
        ("3", 1, 6), ("3", 1, 6), ("9", 1, 7), ("None", 1, 6)]
    assert decontaminate.leaks(spark, frame(spark, []), benchmark(spark)).collect() == []
    assert decontaminate.leaks(spark, frame(spark, rows), benchmark(spark, [])).collect() == []


PAGES = [(1, "http://h.net/a", None), (2, None, "<p>x</p>"), (3, "no scheme", ""), (4, "HTTP://H.NET/a?q#f", "<p>y"),
         (4, "HTTP://H.NET/a?q#f", "<p>y"), (None, "http://h.net/a", "<div><p>z</div></p></nav><p cla"),
         (6, "http://h.net", "<p>" + "long " * 100_000)]


def test_pages(spark):
    got = {(r.page_id, r.url): r.text for r in html_extract.extract(spark, pages(spark, PAGES)).collect()}
    assert got == {(1, "http://h.net/a"): "", (2, None): "x", (3, "no scheme"): "", (4, "HTTP://H.NET/a?q#f"): "y",
                   (None, "http://h.net/a"): "z", (6, "http://h.net"): " ".join(["long"] * 100_000)}
    assert html_extract.extract(spark, pages(spark, PAGES)).count() == len(PAGES)
    assert html_extract.extract(spark, pages(spark, [])).collect() == []
    judged = {(r.page_id, r.url): (r.host, r.path, r.rule, r.verdict)
              for r in url_filter.judge(pages(spark, PAGES)).collect()}
    assert judged[2, None] == judged[3, "no scheme"] == ("", "", None, "allow")
    assert judged[4, "HTTP://H.NET/a?q#f"] == ("h.net", "/a", "net/", "block")
    assert judged[6, "http://h.net"] == ("h.net", "", None, "allow")
    assert url_filter.judge(pages(spark, [])).collect() == []


def test_one_of_repeated_rows_stays(spark):
    kept = simhash.keep_one(spark, frame(spark, DOCS)).collect()
    # 1 and 2 have no word and one fingerprint; 3 stands twice; the row without an id can't be named
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "4", "5", "6", "None"]
    assert len(kept[0]) == 4 + len(EXTRA)


def test_rows_of_one_id_are_judged_by_their_text(spark):
    texts = {x: " ".join(f"{x}{(k * k) % 97}" for k in range(60)) for x in "abcdefg"}
    rows = [(3, "a"), (5, "a"), (5, "b"), (8, "c"), (8, "d"), (9, "e"), (9, "e"), (10, "d"), (11, "f"), (12, "f"), (12, "f"),
            (None, "g"), (None, "g")]
    df = spark.createDataFrame([(i, texts[x], x) for i, x in rows], "doc_id bigint, text string, name string")
    for n in (1, 7):
        kept = sorted(((r.doc_id or 0, r.name) for r in simhash.keep_one(spark, df.repartition(n)).collect()))
        assert kept == [(0, "g"), (0, "g"), (3, "a"), (5, "b"), (8, "c"), (8, "d"), (9, "e"), (11, "f")]
