"""License scan by canonical digest lookup (DataFrame functions only).

A text is brought to a canonical form: lower case, copyright lines dropped,
equivalent spellings mapped to one, punctuation and white space folded. Its
SHA-256 is hash-joined to the digests of the known licences. Every whole text is
looked up, and so is every line of it, because a licence notice usually stands
as a line or file header inside a longer document. For texts of several lines,
every stretch of whole lines that starts like a known one and has its length is
looked up too; there title lines and "All rights reserved" are dropped as well.
The long licences are known by the digests of their published texts (``PUBLISHED``);
more come with ``known``.

Defined cases: a null or empty text has no digest and no match; a text or line
that is empty after canonicalisation is never looked up; repeated rows are
matched row by row; extra input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise

# Licence notices and short licence texts, as published.
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License
is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied. See the License for the specific language governing permissions and limitations under the
License."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the
distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER
IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF
THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the
distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER
IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF
THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in
source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any
and all copyright interest in the software to the public domain. We make this dedication for the
benefit of the public at large and to the detriment of our heirs and successors. We intend this
dedication to be an overt act of relinquishment in perpetuity of all present and future rights to
this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>"""),
]

# Fixed values: (licence, first words, characters and SHA-256 of the canonical body) of published texts.
PUBLISHED = [
    ("Apache-2.0", "terms and conditions", 9632, "8bc274b78ed86c607ba1cda8907d306bdcd748d87218adf3dcc786d7f5be76c9"),
    ("CC0-1.0", "creative commons legal", 6692, "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GPL-2.0", "51 franklin street", 16979, "437ab80c9b89b40ceb1fc89db0aabae11b8a190d75a27530ee4c24d2db94f731"),
    ("GPL-3.0", "everyone is permitted", 33224, "be6cf54fefdf7da1142be7b1618883afb88c7df4b5e6b39786326b10aed10940"),
    ("LGPL-2.1", "51 franklin street", 24992, "82c32324b402165df33af29345155484e3c95cda1600b9e42c1cad0a0df73819"),
    ("LGPL-3.0", "everyone is permitted", 7047, "13980739d6423be0921994d8ce3ce547437735b0e6733161f70b19c962f194b7"),
    ("MPL-2.0", "1 definitions 1", 14236, "e07dcdcc3b2c19db7e604dfb1498cc5dafa0e9cecf6ffc44f7c2b093fe9bafc2"),
]

# Spellings that licence-matching guidelines treat as equal.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"),
    ("sublicence", "sublicense"), ("merchantibility", "merchantability"),
    ("noninfringement", "non infringement"), ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"), ("authorised", "authorized"), ("favour", "favor"),
    ("https", "http"), ("whilst", "while"), ("wilful", "willful"),
]

COPYRIGHT_LINE = r"(?m)^[^\S\n]*(?:[/*#;-]+[^\S\n]*)?(?:copyright|\(c\)|©)(?:[^\S\n]|\(|©)[^\n]*$"
# Canonical lines that are a title or the like, around the body of a licence.
TITLE = (r"^(?:(?:the )?(?:mit|x11|isc|0bsd|zero clause bsd|(?:[0234] clause )?bsd(?: [0234] clause| zero clause)?"
         r"|(?:new|revised|simplified|modified) bsd|unlicense|apache|mozilla public"
         r"|gnu (?:lesser |library |affero )?general public)(?: license)?(?: mit| isc| expat| x11| 0bsd)?"
         r"(?: version [0-9]+(?: [0-9]+)?)?(?: [a-z]+ [0-9]{4})?"
         r"|version [0-9]+(?: [0-9]+){0,2} [a-z]+ [0-9]{4}|all rights reserved|http www apache org licenses)$")
PUNCTUATION = r"[^\p{L}\p{N}\n]+"
# A line that is a known notice has one of these in it; other lines are not digested.
NOTICE_HINT = r"(?i)licen[sc]|permission"


def canonical(text: Column) -> Column:
    """The canonical form of a text: words of letters and digits, single-spaced.

    Copyright lines are dropped before the punctuation is folded, so that a
    holder's name and year never change the digest.
    """
    x = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    x = F.trim(F.regexp_replace(F.regexp_replace(x, PUNCTUATION, " "), r"[ \n]+", " "))
    spelled = x
    for variant, as_ in SPELLINGS:
        spelled = F.regexp_replace(spelled, rf"\b{variant}\b", as_)
    # one pass tells the rare text that has any variant spelling
    return F.when(x.rlike(rf"\b({'|'.join(v for v, _ in SPELLINGS)})\b"), spelled).otherwise(x)


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form; null where that form is empty or null."""
    c = canonical(text)
    return F.when(c != "", F.sha2(c, 256))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license): one row for each digest of a known licence text."""
    rows = spark.createDataFrame(known or KNOWN, "license string, text string")
    return (rows.select(digest(F.col("text")).alias("digest"), "license")
            .where("digest is not null").groupBy("digest").agg(F.min("license").alias("license")))


def body(text: Column) -> Column:
    """The canonical lines of a text, without empty ones, titles and the like."""
    return F.filter(F.transform(F.split(text, "\n"), canonical), lambda x: (x != "") & ~x.rlike(TITLE))


def known_bodies(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> list[tuple[str, str, int, str]]:
    """(licence, first three words, bytes, digest) of each known text of several lines."""
    rows = spark.createDataFrame(known or KNOWN, "license string, text string").where(F.contains("text", F.lit("\n")))
    rows = rows.select("license", F.concat_ws(" ", body(F.col("text"))).alias("c")).where("c <> ''")
    return sorted({*PUBLISHED, *(tuple(r) for r in rows.select(
        "license", F.substring_index("c", " ", 3), F.octet_length("c"), F.sha2("c", 256)).collect())})


def _licence_of(bodies: list[tuple[str, str, int, str]]) -> Column:
    """A literal map from the digest to the licence, of two the least."""
    least = {d: min(k for k, *_, e in bodies if e == d) for *_, d in bodies}
    return F.create_map(*[F.lit(v) for pair in sorted(least.items()) for v in pair])


def _head(lines: Column, i: Column) -> Column:
    """The first three words from line ``i`` (from 1) on, wherever the lines break."""
    return F.substring_index(F.concat_ws(" ", F.slice(lines, i, F.lit(3))), " ", 3)


def has_head(lines: Column, bodies: list[tuple[str, str, int, str]]) -> Column:
    """Does any line begin like a known body?"""
    heads = sorted({h for _, h, _, _ in bodies})
    firsts = sorted({h.split(" ")[0] for h in heads})
    at = F.transform(lines, lambda x, i: F.when(F.substring_index(x, " ", 1).isin(firsts), _head(lines, i + 1)))
    return F.exists(at, lambda h: F.coalesce(h.isin(heads), F.lit(False)))


def stretches(texts: DataFrame, bodies: list[tuple[str, str, int, str]]) -> DataFrame:
    """(key, in_lines): the licences whose body is a stretch of whole lines of ``texts`` (key, lines).

    Running sums of the lines' bytes give where each line starts and ends in the joined text. A
    start of a known body is matched with the line end that lies a known body's length further on, an
    equi-join, and only those stretches are cut out and digested: work and memory
    follow the text, however many of its lines begin like a licence.
    """
    sizes: dict[str, set[int]] = {}
    for _, head, n, _ in bodies:
        sizes.setdefault(head, set()).add(n)
    of = F.create_map(*[x for h, ns in sorted(sizes.items()) for x in (F.lit(h), F.array(*[F.lit(n) for n in sorted(ns)]))])
    order = Window.partitionBy("key").orderBy("pos")
    first = F.substring_index("line", " ", 3)
    each = texts.select("key", F.posexplode("lines").alias("pos", "line")).withColumns({
        "end": F.sum(F.octet_length("line") + 1).over(order.rowsBetween(Window.unboundedPreceding, 0)),
        "head": F.substring_index(F.concat_ws(" ", first, F.lead(first, 1).over(order), F.lead(first, 2).over(order)), " ", 3)})
    each = each.select("key", "end", "head", (F.col("end") - F.octet_length("line") - 1).alias("start"))
    starts = each.where(F.col("head").isin(sorted(sizes))).select("key", "start", F.explode(of[F.col("head")]).alias("n"))
    found = (starts.withColumn("end", F.col("start") + F.col("n") + 1).join(each.select("key", "end"), ["key", "end"])
             .groupBy("key").agg(F.collect_list(F.struct(F.col("start").cast("int").alias("start"), "n")).alias("at")))
    # joined once, below the join, and not for every stretch
    joined, lookup = texts.select("key", F.concat_ws(" ", "lines").cast("binary").alias("joined")), _licence_of(bodies)
    cut = F.transform("at", lambda x: lookup[F.sha2(F.substring("joined", x["start"] + 1, x["n"]), 256)])
    return (found.join(joined, "key").select("key", F.array_distinct(F.filter(cut, lambda x: x.isNotNull())).alias("in_lines"))
            .where(F.size("in_lines") > 0))


def scan(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(id, text_digest, license, notices, n_copyright_lines) of every row.

    ``license`` is the licence whose digest the entire text has (hash join), or its body.
    ``notices`` is the sorted, distinct list of licences whose digest a single
    line or a stretch of lines has. The known licences are a fixed parameter of some dozens of rows:
    that bounds the broadcast, and the line lookup is a literal map of them.
    """
    digests = known_digests(spark, known)
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(NOTICE_HINT))
    bodies = known_bodies(spark, known)
    # the first words of any body, however they are wrapped, must be there
    gap = r"[^\p{L}\p{N}]+"
    heads = "|".join(sorted({gap.join(h.split(" ")).replace("license", "licen[sc]e") for _, h, _, _ in bodies}))
    # texts that may hold a body, once each, with their lines as stored rows: an expression would be
    # made anew for every line that is looked at
    key = F.when(F.col("text").rlike(rf"(?i)(?:{heads})"), F.sha2("text", 256))
    near = (base.select(key.alias("key"), "text").where("key is not null").groupBy("key").agg(F.first("text").alias("text"))
            .select("key", body(F.col("text")).alias("lines")))
    near = materialise(spark, near, "licenses-near")
    long = stretches(near.where(has_head(F.col("lines"), bodies)), bodies)
    of_body = _licence_of(bodies)[F.sha2(F.concat_ws(" ", "lines"), 256)]
    long = near.select("key", of_body.alias("of_body")).join(long, "key", "left").where("of_body is not null or in_lines is not null")
    whole = base.select(
        # texts without a body get keys that are all different and match nothing
        F.coalesce(key, F.concat(F.lit("-"), F.xxhash64("id", "text").cast("string"))).alias("key"), "id",
        digest(F.col("text")).alias("text_digest"),
        F.transform(lines, digest).alias("line_digests"),
        F.regexp_count(F.lower("text"), F.lit(COPYRIGHT_LINE)).cast("long").alias("n_copyright_lines"))
    lookup = F.create_map(*[F.lit(v) for row in digests.collect() for v in row])   # len(known) rows
    found = F.filter(F.transform("line_digests", lambda d: lookup[d]), lambda x: x.isNotNull())
    found = F.array_sort(F.array_distinct(F.concat(found, F.coalesce("in_lines", F.array().cast("array<string>")))))
    return (whole.join(long, "key", "left").join(F.broadcast(digests), whole.text_digest == digests.digest, "left")
            .select(F.col("id").alias(id_col), "text_digest", F.coalesce("license", "of_body").alias("license"),
                    found.alias("notices"), "n_copyright_lines"))
