"""Page differencing: short stories under large templates, inline names, odd markup in linear time, repeated rows,
and the nearest page against all pairs."""

import random
import time

import pytest

from quartermaster.llm import html_extract
from quartermaster.llm.html_extract import Page, common, extract

SCHEMA = "page_id bigint, url string, html string"


def divs(lines):
    return "".join(f"<div>{x}</div>" for x in lines)


@pytest.mark.parametrize("n_menu", [1, 4, 12, 40, 150])
def test_short_stories_lose_their_template(spark, n_menu):
    """Template shares of about 0.5 to 0.99; its longest line is longer than the story, too."""
    menu = [f"Menu entry {k}" for k in range(n_menu - 1)] + ["The longest line of the menu is longer than a story"]
    rows = [(i, f"https://h.org/{i:03d}", divs(menu[:n_menu // 2] + [f"A story of {i}."] + menu[n_menu // 2:]))
            for i in range(30)]
    got = extract(spark, spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert {r.page_id: r.text for r in got} == {i: f"A story of {i}." for i in range(30)}


@pytest.mark.parametrize("html, text", [
    ('<article><p>See <a class="related-link">the paper</a> for more.</p></article>', "See the paper for more."),
    ('<article><p>A <span class="notice">quick</span> look.</p></article>', "A quick look."),
    ('<article><p>Prose of the article.</p><p><span class="notice">Notice.</span></p></article>', "Prose of the article."),
    ('<article><p>Prose of it. <span class="ad">Buy!</span></p></article>', "Prose of it."),
    ('<article><p>Prose of the article.</p><span class="menu"><p>One</p><p>Two</p></span></article>', "Prose of the article.")])
def test_inline_names(html, text):
    assert Page(html).text(None) == text


@pytest.mark.parametrize("html", [
    "<div>" * 50_000 + "x" + "</i>" * 100_000, '<a ">" ' * 150_000, '<a b=">" \' ' * 100_000, "<a =\"'>" * 100_000,
    "".join(f"<div class='menu{i % 7}'>x" for i in range(60_000)), '<p class="x> ">a' * 60_000, "<!--" * 250_000,
    "<script>" * 100_000, "<p" * 300_000, "&lt" * 300_000])
def test_odd_markup_takes_linear_time(html):
    started = time.process_time()
    Page(html)
    assert time.process_time() - started < 10


def test_quotes_that_never_end():
    """A tag whose quote never ends stops at the first ``>``; later tags are read as before."""
    assert Page('<p title="x>one</p><p>two</p>').text(None) == "one\ntwo"
    assert Page("<p>a</p><p t='x>b</p><p>c<a").text(None) == "a\nb\nc"


def test_large_alignments_are_kept_in_part(monkeypatch):
    rng = random.Random(5)
    for _ in range(30):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randint(0, 40))] for _ in range(2))
        monkeypatch.setattr(html_extract, "TABLE_BITS", 1 << 27)
        whole = common(a, b)
        monkeypatch.setattr(html_extract, "TABLE_BITS", 0)
        assert common(a, b) == whole


def test_repeated_rows_and_pages_of_one_key(spark):
    """3,000 equal rows give 3,000 equal texts; other html of the same key is another page."""
    menu = divs(["Home", "About"])
    rows = [(7, "https://h.org/a?x", f"{menu}<div>Equal rows.</div>")] * 3000 + [
        (7, "https://h.org/a?y", f"{menu}<div>Another page.</div>"), (None, None, f"{menu}<div>No key.</div>"),
        (None, None, f"{menu}<div>No key either.</div>")]
    got = extract(spark, spark.createDataFrame(rows, SCHEMA).repartition(4)).groupBy("page_id", "url", "text").count()
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        (7, "https://h.org/a?x", "Equal rows.", 3000), (7, "https://h.org/a?y", "Another page.", 1),
        (None, None, "No key.", 1), (None, None, "No key either.", 1)], key=str)


def test_nearest_page_against_all_pairs(spark):
    """The lines that go are those of the page with the longest common path prefix among all of the host."""
    rng = random.Random(3)
    paths = sorted({"/" + "".join(rng.choice("ab/") for _ in range(rng.randint(1, 9))) for _ in range(120)})
    lines = [sorted(rng.sample([f"Line {k:02d}" for k in range(40)], 6)) + [f"Own words of page number {i}, only here."] * 2
             for i in range(len(paths))]
    rows = [(i, f"https://h.org{p}", divs(x)) for i, (p, x) in enumerate(zip(paths, lines))]
    got = {r.page_id: r.text for r in extract(spark, spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()}

    def prefix(a, b):
        return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    for i, p in enumerate(paths):
        best = min((j for j in range(len(paths)) if j != i), key=lambda j: (-prefix(p, paths[j]), j > i, abs(j - i)))
        assert got[i] == "\n".join(x for x in lines[i] if x not in lines[best])
