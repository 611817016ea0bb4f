"""Main text of web pages by nearest-URL page differencing.

A page is cut into text lines, one per block element. Lines in elements that are
no content by their markup (menus, footers, forms, scripts, comments, hidden
ones) are dropped at once. Names of elements (class, id, role) and the declared
main part are weighed: a name all of such words (``cookie-notice``) drops an
element unless it holds the whole page, one with such a word (``nav-open``) unless
it holds most of its text, and what is outside ``article`` or ``main`` goes if at least half of
the text is inside. Within each host, every page is paired with the page whose
URL path is nearest; the two line sequences are aligned by their longest common
subsequence, and shared lines are deleted: a template repeats, an article does
not. What the page itself marks as prose of its article (a paragraph, heading,
list item or table cell inside ``article`` or ``main``) goes only if at least
half of the host's pages have that line too: an advert does, a quotation doesn't.
The numbers of pages by host and line are counted over all pages. A line that pages
with another main line have, or most pages of the host, is its template. Where the
nearest page is a copy, judged by the lines that are no template, the one on the
other side is taken; where both are, the template goes. A name on an inline element
inside running text (``<a class="related-link">``) says nothing, unless it is an advert's.

The nearest path, by the length of the common prefix, is always next to a page's
own in the order of (host, path, id, digest of the html). So the pages are range-partitioned in that
order and each task streams through its range with one page before and one after
the current. The range bounds come from the keys alone (two keys a range on the
driver), and a range also receives the last page before and the first page after
it, so the result doesn't depend on the ranges, and a hot host is just many
ranges.

Defined cases: null or empty html gives an empty text; a null URL, or one without
``://``, belongs to the empty host and path; a page without a partner keeps all
its lines; a page that is template alone is judged by all its lines and keeps them if nearly all are shared;
rows with equal host, path, id and html are one page and get the same text;
broken, unclosed or cut-off markup never fails; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from math import isqrt

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise
from .url_filter import host, path

COPY_SHARE = 0.9          # a partner that shares more of the page's characters is a copy of it
SHARE = 0.1               # share of a host's different pages that make a line a repeated one
MANY, MANY_SHARE = 3, 0.5 # as many of them, and such a share, make a line of declared prose no prose
TEMPLATE_SHARE = 0.75     # and such a share makes any line the host's template
TABLE_BITS = 1 << 27      # an alignment's table beyond this size is kept in part and made again
OUT_ROWS, OUT_CHARS = 500, 16_000_000       # rows and characters of a result batch, about
PAGES_PER_TASK = 4000     # pages that a task streams through, about
RANGES_PER_PARTITION = 4

PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th caption figcaption".split())
BLOCK = PROSE | frozenset(
    "address article aside body center details dialog div dl fieldset figure footer form head header hgroup hr html "
    "legend main menu nav ol optgroup option search section summary table tbody tfoot thead title tr ul".split())
# Elements whose text is never content, and those whose inside isn't markup.
DROPPED = frozenset("nav footer aside form dialog menu head noscript template svg math object canvas audio video "
                    "select option button datalist search map".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words of class, id and role names that mark what is no content.
NO_CONTENT = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner banners breadcrumb breadcrumbs "
    "comment comments commentlist disqus respond replies consent cookie cookies gdpr notice notices notification "
    "alert disclaimer footer foot copyright colophon header masthead topbar navbar nav navigation menu menus "
    "sidebar sidenav rail widget widgets promo promotion promoted sponsor sponsored sponsors newsletter subscribe "
    "subscription signup popup modal overlay share sharing social related recommended recommendations "
    "pagination pager toolbar skip search searchbox login complementary contentinfo".split())
# Those of them that mark an advert inside running text too.
ADVERT = frozenset("ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsors sponsored promo "
                   "promoted".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTRIBUTES = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_SPECIAL = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def _marks(attributes: str) -> tuple[bool, int, int, bool]:
    """(whether the element is hidden, 2 where a name is all of words for no content and 1 where it has one,
    2 for an article's body and 1 for the main part, whether a name is an advert's)."""
    named, rank, hidden, advert = 0, 0, False, False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            for word in value.split():
                parts = [x.lower() for x in _NAME.findall(word)]
                if parts and parts[0] not in ("has", "no", "with", "without"):
                    named = max(named, 2 * NO_CONTENT.issuperset(parts), not NO_CONTENT.isdisjoint(parts))
                    advert = advert or ADVERT.issuperset(parts)
        elif name == "role":
            named = max(named, 2 * (not NO_CONTENT.isdisjoint(value.lower().split())))
            rank = max(rank, value.lower() == "main")
        elif name == "itemprop":
            rank = max(rank, 2 * (value.lower() == "articlebody"))
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif name == "style":
            hidden = hidden or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
    return hidden, named, rank, advert


class _Ends:
    """Finds where tags end: at ``>`` outside quotes or, if there is none, at the first ``>``.

    From a quote on, the search is the same whichever tag it comes from. So the quotes that
    lead to no end are remembered, and all searches of a page together are linear.
    """

    def __init__(self, markup: str):
        self.markup, self.dead = markup, set()

    def __call__(self, at: int) -> int:
        """The position after the tag whose attributes begin at ``at``; 0 if it is cut off."""
        if not self.dead:
            m = _ATTRIBUTES.match(self.markup, at)
            if m:
                return m.end()
        seen, here = [], at
        while m := _SPECIAL.search(self.markup, here):
            if m[0] == ">":
                return m.end()
            if m.start() in self.dead:
                break
            seen.append(m.start())
            here = self.markup.find(m[0], m.end()) + 1
            if not here:
                break
        self.dead.update(seen)
        return self.markup.find(">", at) + 1


class Page:
    """The lines of a page: ``lines`` its candidate texts, ``fixed`` which of them are declared prose."""

    def __init__(self, markup: str | None):
        found, marks = _lines(markup or "")
        half, inside = sum(len(text) for _, _, text, _ in found) / 2, [0] * len(marks.parent)
        for _, _, text, mark in found:
            inside[mark] += len(text)
        for k in range(len(inside) - 1, 0, -1):
            inside[marks.parent[k]] += inside[k]
        # a name that only has such a word says nothing about most of the page's text, and none about all of it
        content = [True] * len(inside)
        for k in range(1, len(inside)):
            content[k] = content[marks.parent[k]] and inside[k] > half * (1.999 if marks.whole[k] else 1)
        found = [(r, prose, text) for r, prose, text, mark in found if content[mark]]
        # the innermost declared part that holds at least half of what is left is the page
        half = sum(len(text) for _, _, text in found) / 2
        rank = next(k for k in (2, 1, 0) if sum(len(text) for r, _, text in found if r >= k) >= half)
        rows = [(text, r > 0 and prose) for r, prose, text in found if r >= rank]
        self.lines = [t for t, _ in rows]
        self.fixed = [f for _, f in rows]

    def text(self, partner: Page | None, other: Page | None = None, known: dict | None = None) -> str:
        """The page's text without the lines that it shares with its partner, or the other page if that is a copy.

        ``known``: of lines that the host repeats, by key, (whether they are its template,
        whether as many pages have it as make it no prose).
        """
        known = known or {}
        keys = [line_key(t) for t in self.lines] if known else []
        template = {i for i, k in enumerate(keys) if known.get(k, (False, False))[0]}
        own = [i for i in range(len(self.lines)) if i not in template]
        shared = None
        for page in (partner, other):
            if page is not None and shared is None:
                shared = self._unless_copy(common(self.lines, page.lines), own or range(len(self.lines)))
        if shared is None:
            shared = template if own else set()
        return "\n".join(t for i, (t, f) in enumerate(zip(self.lines, self.fixed))
                         if i not in shared or f and not (keys and known.get(keys[i], (False, False))[1]))

    def _unless_copy(self, shared: set[int], judged: Iterable[int]) -> set[int] | None:
        most = COPY_SHARE * sum(len(self.lines[i]) for i in judged)
        return None if sum(len(self.lines[i]) for i in judged if i in shared) > most else shared

    def evidence(self) -> list[tuple[int, int, int]]:
        """(line, the page's lines, its longest other line) of each different line, as keys."""
        longest = sorted(dict.fromkeys(self.lines), key=lambda t: (-len(t), t))
        keys = [line_key(t) for t in longest]
        whole = line_key("\n".join(self.lines))
        return [(k, whole, keys[0] if i else keys[1] if len(keys) > 1 else 0) for i, k in enumerate(keys)]


def line_key(text: str) -> int:
    x = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return x - (1 << 64) if x >> 63 else x


class _Names:
    """Elements whose names mark no content, as a tree: number 0 is the page, parents come before children.

    ``whole``: the name is all of such words. ``light``: it, or one around it, is an inline
    element's and no advert's; ``base`` is then the innermost element around that isn't light.
    """

    def __init__(self):
        self.parent, self.whole, self.light, self.base = [0], [False], [False], [0]

    def add(self, parent: int, whole: bool, light: bool) -> int:
        light = light or self.light[parent]
        self.base.append(self.base[parent] if light else len(self.parent))
        self.parent.append(parent)
        self.whole.append(whole)
        self.light.append(light)
        return len(self.parent) - 1


def _lines(markup: str) -> tuple[list[tuple[int, bool, str, int]], _Names]:
    """(rank, prose, text, number of the named element around it) of each block with text, and those elements.

    Rank is 2 in an article, 1 in the main part, else 0.
    """
    out, buffer, at, prose = [], [], 0, False
    stack: list[tuple[str, int, bool, int]] = [("", 0, False, 0)]     # (tag, rank, no content, named element)
    opened: dict[str, int] = {}                                       # tag: how many of it are on the stack
    seen: dict[str, tuple[bool, int, int, bool]] = {}
    names, tag_end = _Names(), _Ends(markup)

    def flush():
        if not buffer:
            return
        light = names.light
        running = any(light[k] for k, _ in buffer) and any(
            not light[k] and any(map(str.isalnum, piece)) for k, piece in buffer)
        parts: dict[int, list[str]] = {}
        for k, piece in buffer:
            parts.setdefault(names.base[k] if running else k, []).append(piece)
        buffer.clear()
        for k, pieces in parts.items():
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                out.append((stack[-1][1], prose, text, k))

    def close():
        opened[stack[-1][0]] -= 1
        stack.pop()

    while True:
        m = _TOKEN.search(markup, at)
        end = m.start() if m else len(markup)
        if end > at and not stack[-1][2]:
            buffer.append((stack[-1][3], markup[at:end]))
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue                                          # a comment or declaration
        tag, at = m[2].lower(), tag_end(at)
        if not at:
            break                                             # cut off
        attributes = markup[m.end():at - 1]
        if m[1]:
            if tag in BLOCK:
                flush()
                prose = False
            if opened.get(tag):
                while stack[-1][0] != tag:
                    close()
                close()
            continue
        if tag in RAW:
            ended = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(markup, at)
            at = ended.end() if ended else len(markup)
            continue
        if tag == "br":
            buffer.append((stack[-1][3], " "))
            continue
        if tag in BLOCK:
            flush()
            prose = tag in PROSE
            while stack[-1][0] == "p":                        # a block ends an open paragraph
                close()
        _, rank, dropped, around = stack[-1]
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            continue
        if attributes not in seen:
            seen[attributes] = _marks(attributes) if attributes.strip() else (False, 0, 0, False)
        no_content, named, declared, advert = seen[attributes]
        if tag in ("html", "body"):
            no_content, named = False, 0
        no_content = no_content or tag in DROPPED or tag == "header" and rank == 0
        if rank and tag == "header":
            no_content, named = False, 0                        # an article's own header has its title
        rank = max(rank, declared, 2 if tag == "article" else 1 if tag == "main" else 0)
        if named:
            around = names.add(around, named == 2, tag not in BLOCK and not advert)
        if tag in BLOCK and tag != "p" or no_content or named or declared:
            stack.append((tag, rank, dropped or no_content, around))
            opened[tag] = opened.get(tag, 0) + 1
    flush()
    return out, names


def common(a: list[str], b: list[str]) -> set[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``.

    Bit-parallel: a row of the table is one number with a bit per line of ``b``,
    0 where the length grows. Equal ends and lines without a twin go first.
    """
    n, found = min(len(a), len(b)), set()
    low = 0
    while low < n and a[low] == b[low]:
        found.add(low)
        low += 1
    high = 0
    while high < n - low and a[-1 - high] == b[-1 - high]:
        found.add(len(a) - 1 - high)
        high += 1
    inner_b, inner_a = b[low:len(b) - high], a[low:len(a) - high]
    here, there = set(inner_a), set(inner_b)
    y = [x for x in inner_b if x in here]
    x = [(i, v) for i, v in enumerate(inner_a, low) if v in there]
    if not x:
        return found
    where: dict[str, int] = {}
    for j, v in enumerate(y):
        where[v] = where.get(v, 0) | 1 << j
    full = (1 << len(y)) - 1

    def rows_from(row: int, part: list[tuple[int, str]]) -> list[int]:
        rows = []
        for _, v in part:
            hit = row & where[v]
            row = (row + hit | row - hit) & full
            rows.append(row)
        return rows

    # only the row before each block of x is kept; the way back makes a block's rows again
    step = len(x) if len(x) * len(y) <= TABLE_BITS else isqrt(len(x)) + 1
    starts, rows = [full], []
    for i in range(0, len(x), step):
        rows = rows_from(starts[-1], x[i:i + step])
        starts.append(rows[-1])
    k, j, block = len(x) - 1, len(y), (len(x) - 1) // step
    while k >= 0 and j:
        if k < block * step:
            block -= 1
            rows = rows_from(starts[block], x[block * step:(block + 1) * step])
        row = rows[k - block * step]
        last = rows[k - block * step - 1] if k > block * step else starts[block]
        if row >> (j - 1) & 1:                                # as long without y[j - 1]
            j -= 1
        elif _zeros(last, j) == _zeros(row, j):               # as long without x[k]
            k -= 1
        else:
            found.add(x[k][0])
            k, j = k - 1, j - 1
    return found


def _zeros(row: int, j: int) -> int:
    return j - (row & (1 << j) - 1).bit_count()


KEY = ("host", "path", "id", "digest")


def _key(host_: str, path_: str, page, digest: int) -> tuple:
    return host_, path_, page is not None, page, digest


def ranges(pages: DataFrame, n: int) -> list[tuple[tuple, tuple]]:
    """(first key, last key) of up to ``n`` ranges of the pages in their order, from the keys alone."""
    keys = pages.select(*KEY).repartitionByRange(n, *KEY)
    whole = F.struct(*KEY)
    found = (keys.groupBy(F.spark_partition_id().alias("p")).agg(F.min(whole).alias("a"), F.max(whole).alias("b"))
             .collect())
    return sorted((_key(*r.a), _key(*r.b)) for r in found)


def _destinations(bounds: list[tuple[tuple, tuple]]):
    """Column function: the page's own range, and -1 - range of each that needs it as context."""
    firsts = [a for a, _ in bounds]

    @F.arrow_udf("array<int>")
    def where(hosts: pa.Array, paths: pa.Array, ids: pa.Array, digests: pa.Array) -> pa.Array:
        out = []
        for row in zip(hosts.to_pylist(), paths.to_pylist(), ids.to_pylist(), digests.to_pylist()):
            key = _key(*row)
            r = max(0, bisect_right(firsts, key) - 1)
            to = [r]
            if key == bounds[r][0] and r > 0:
                to.append(-1 - (r - 1))
            if key == bounds[r][1] and r + 1 < len(bounds):
                to.append(-1 - (r + 1))
            out.append(to)
        return pa.array(out, pa.list_(pa.int32()))

    return where


def _covering(bounds: list[tuple[tuple, tuple]]):
    """Column function: every range that has pages of the host."""
    firsts, lasts = [a[0] for a, _ in bounds], [b[0] for _, b in bounds]

    @F.arrow_udf("array<int>")
    def where(hosts: pa.Array) -> pa.Array:
        return pa.array([list(range(bisect_left(lasts, h), bisect_right(firsts, h))) for h in hosts.to_pylist()],
                        pa.list_(pa.int32()))

    return where


def _prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _nearest(row: dict, around: list[dict | None]) -> list[Page]:
    """The pages around of the same range and host, the one with the nearest path first; of two, the one before."""
    near = [x for x in around if x and (x["range"], x["host"]) == (row["range"], row["host"])]
    return [x["page"] for x in sorted(near, key=lambda x: -_prefix(x["path"], row["path"]))]


def repeated(pages: DataFrame) -> DataFrame:
    """(host, known): the lines that different pages of a host repeat, as keys with what ``Page.text`` asks of them.

    A line that ``SHARE`` of the host's different pages have; so a host has at most
    1 / ``SHARE`` times as many as a page has lines.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, rows = [], []
            for host_, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                found = Page(html).evidence()
                rows += found
                hosts += [host_] * len(found)
            cols = [pa.array(x, pa.int64()) for x in zip(*rows)] if rows else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *cols], ["host", "line", "page", "main"])

    lines = pages.select("host", "html").mapInArrow(run, "host string, line bigint, page bigint, main bigint")
    lines = materialise(pages.sparkSession, lines.groupBy("host", "line", "page").agg(F.min("main").alias("main")),
                        "html-lines")
    found = (lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"), (F.min("main") != F.max("main")).alias("foreign"))
             .where("n > 1"))
    size = lines.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    return (found.join(size, "host").where(F.col("n") >= SHARE * F.col("pages"))
            .withColumn("many", F.col("n") >= F.greatest(F.lit(MANY), MANY_SHARE * F.col("pages")))
            .withColumn("template", F.col("foreign") | (F.col("many") & (F.col("n") >= TEMPLATE_SHARE * F.col("pages"))))
            .groupBy("host").agg(F.collect_list(F.struct("line", "template", "many")).alias("known")))


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams through sorted ranges; each page with the one before and the one after it."""
    out, kinds = {"id": [], "url": [], "text": []}, {}

    def made() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()], list(out))
        for v in out.values():
            v.clear()
        return batch

    def finish(here: dict | None, before: dict | None, after: dict | None) -> Iterator[pa.RecordBatch]:
        if here is None or here["context"]:
            return
        near = [*_nearest(here, [before, after]), None, None][:2]
        text = here["page"].text(*near, known[1] if known[0] == here["key"][:2] else None)
        most = max(1, min(OUT_ROWS, OUT_CHARS // (len(text) + 1)))
        for url, n in here["urls"].items():                   # repeated rows: one text
            while n:
                some = min(n, most)
                n -= some
                out["id"] += [here["id"]] * some
                out["url"] += [url] * some
                out["text"] += [text] * some
                held[0] += some * len(text)
                if len(out["id"]) >= OUT_ROWS or held[0] >= OUT_CHARS:
                    held[0] = 0
                    yield made()

    before, here, held = None, None, [0]                      # held: characters of the texts in out
    known = None, {}                                          # the repeated lines of one range's host
    for batch in batches:
        kinds["id"] = batch.schema.field("id").type
        for row in batch.to_pylist():
            if row["known"] is not None:                      # ahead of its host's pages
                yield from finish(here, before, None)
                before, here = None, None
                known = (row["range"], row["host"]), {x["line"]: (x["template"], x["many"]) for x in row["known"]}
                continue
            row["key"] = tuple(row[k] for k in ("range", *KEY))
            if here is not None and row["key"] == here["key"]:
                here["urls"][row["url"]] = here["urls"].get(row["url"], 0) + 1
                continue
            row["page"], row["urls"] = Page(row.pop("html")), {row["url"]: 1}
            yield from finish(here, before, row)
            before, here = here, row
    yield from finish(here, before, None)
    if out["id"]:
        yield made()


def extract(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """(id, url, text): the main text of every page."""
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"),
                        F.xxhash64(html_col).alias("digest"))
    # the number of tasks follows the pages, so that a task's share stays the same at any size
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-base.count() // PAGES_PER_TASK))
    bounds = ranges(base, n * RANGES_PER_PARTITION)
    kind = base.schema["id"].dataType.simpleString()
    if not bounds:
        return base.select(F.col("id").alias(id_col), F.col("url").alias(url_col), F.lit("").alias("text"))
    to = _destinations(bounds)(*KEY)
    dealt = base.withColumn("to", F.explode(to))
    dealt = dealt.select("id", "url", "host", "path", "digest", "html", (F.col("to") < 0).alias("context"),
                         F.when(F.col("to") < 0, -1 - F.col("to")).otherwise(F.col("to")).alias("range"))
    lines = repeated(base).withColumn("range", F.explode(_covering(bounds)("host")))
    dealt = dealt.withColumn("known", F.lit(None).cast(lines.schema["known"].dataType))
    dealt = dealt.unionByName(lines.withColumn("context", F.lit(False)), allowMissingColumns=True)
    # ranges are dealt to the tasks in turn
    streamed = dealt.repartitionById(n, F.col("range") % n).sortWithinPartitions(
        "range", "host", F.col("known").isNull(), "path", "id", "digest")
    return (streamed.mapInArrow(_difference, f"id {kind}, url string, text string")
            .withColumnRenamed("id", id_col).withColumnRenamed("url", url_col))
