"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from . import hard_negatives, licenses, phrases, secrets, url_filter


def _sql(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _alt(terms) -> str:
    return "|".join(sorted(terms, key=lambda t: (-len(t), t)))


def op3_url_filter() -> str:
    hits = " + ".join(
        rf"CAST(regexp_matches(lower(coalesce(url, '')), '(^|[^a-z0-9]){t}($|[^a-z0-9])') AS INT)"
        for t in url_filter.SOFT)
    strict = " + ".join(
        rf"CAST(regexp_matches(lower(coalesce(url, '')), '(^|[^a-z0-9]){t}($|[^a-z0-9])') AS INT)"
        for t in url_filter.STRICT)
    fits = []
    for rule, verdict in sorted(url_filter.RULES, key=lambda r: (-len(r[0]), r[0])):
        h, _, p = rule.partition("/")
        fits.append((f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}')", rule, verdict))
    return rf"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path,
         CAST({strict} AS BIGINT) AS n_strict, CAST({hits} AS BIGINT) AS n_soft
  FROM pages)
SELECT page_id, host, path,
       CASE {' '.join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits)} END AS rule,
       CASE {' '.join(f"WHEN {c} THEN '{v}'" for c, _, v in fits)}
            WHEN n_strict >= 1 OR n_soft >= {url_filter.SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict,
       n_strict, n_soft
FROM parts"""


def _canonical(x: str) -> str:
    x = f"regexp_replace(lower({x}), {_sql(licenses.COPYRIGHT_LINE)}, '', 'g')"
    x = f"regexp_replace({x}, {_sql(licenses.PUNCTUATION)}, ' ', 'g')"
    x = f"trim(regexp_replace({x}, '[ \\n]+', ' ', 'g'))"
    for variant, as_ in licenses.SPELLINGS:
        x = rf"regexp_replace({x}, '\b{variant}\b', '{as_}', 'g')"
    return x


def op5_license_scan() -> str:
    known = ", ".join(f"({_sql(k)}, {_sql(t)})" for k, t in licenses.KNOWN)
    return rf"""
WITH known AS (
  SELECT sha256({_canonical('t')}) AS digest, min(l) AS license
  FROM (VALUES {known}) v(l, t) GROUP BY 1),
rows AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
canon AS (
  SELECT r, doc_id, text, {_canonical('text')} AS c FROM rows),
lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM rows),
hits AS (
  SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
  FROM (SELECT r, {_canonical('line')} AS c FROM lines WHERE regexp_matches(line, {_sql(licenses.NOTICE_HINT)})) x
  JOIN known ON known.digest = sha256(x.c) WHERE x.c <> '' GROUP BY r)
SELECT doc_id, CASE WHEN c <> '' THEN sha256(c) END AS text_digest, license,
       coalesce(notices, '') AS notices,
       CAST(len(regexp_extract_all(lower(text), {_sql(licenses.COPYRIGHT_LINE)})) AS BIGINT) AS n_copyright_lines
FROM canon LEFT JOIN known ON c <> '' AND known.digest = sha256(c) LEFT JOIN hits USING (r)"""


def op7_quality_rules() -> str:
    return r"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
base AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM rows),
windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM base WHERE len(w) >= 3)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
stats AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(len(l) AS BIGINT) AS n_lines,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
         length(text) - length(regexp_replace(text, '[A-Za-z]', '', 'g')) AS n_letters
  FROM base),
judged AS (
  SELECT *, coalesce(n_repeat_words, 0) AS n_rep FROM stats LEFT JOIN covered USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, CAST(n_rep AS BIGINT) AS n_repeat_words,
       n_words < 50 OR 100 * n_rep > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_rep > 50 * n_words OR 10 * n_symbols > n_words
            OR 2 * n_upper > n_letters OR 2 * n_dup_lines > n_lines
            OR word_chars < 2 * n_words OR word_chars > 40 * n_words) AS kept
FROM judged"""


def op10_secret_scan() -> str:
    found = " UNION ALL ".join(f"""
  SELECT r, {rank} AS rank, '{x.kind}' AS kind, i, len(groups[i]) AS n,
         CAST(coalesce(list_sum([length(y) FOR y IN gaps[1:i]]), 0)
              + coalesce(list_sum([length(y) FOR y IN hits[1:i - 1]]), 0) AS BIGINT) AS s, length(hits[i]) AS l
  FROM (SELECT r, gaps, hits, groups, unnest(range(1, len(hits) + 1)) AS i
        FROM (SELECT r, string_split_regex(text, {_sql(x.pattern)}) AS gaps,
                     regexp_extract_all(text, {_sql(x.pattern)}, 0) AS hits,
                     regexp_extract_all(text, {_sql(x.pattern)}, {x.group}) AS groups FROM rows) a) b
  WHERE len(groups[i]) >= {x.least}""" for rank, x in enumerate(secrets.RULES))
    return f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({found}),
each AS (SELECT r, rank, kind, s, kind || ':' || s || ':' || (s + l) AS span FROM found),
lists AS (
  SELECT r, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         coalesce(string_agg(span, ',' ORDER BY s, rank) FILTER (WHERE rank < {len(secrets.BASE)}), '') AS base,
         string_agg(span, ',' ORDER BY s, rank) AS spans
  FROM each GROUP BY r)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM rows LEFT JOIN lists USING (r)"""


def op12_hard_negatives() -> str:
    m = hard_negatives
    return f"""
WITH rows AS (
  SELECT vec_id AS id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         [CAST(floor({m.SCALE} * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT a.id AS anchor, a.label = r.label AS same, r.id, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.id % {m.ANCHOR_EVERY} = 0 AND a.id <> r.id AND len(a.v) = len(r.v)),
positives AS (
  SELECT anchor, id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= {m.POSITIVES}),
found AS (
  SELECT anchor, positive_id, positive_score, id, score,
         row_number() OVER (PARTITION BY anchor, positive_id ORDER BY score DESC, id) AS rank
  FROM positives JOIN pairs USING (anchor)
  WHERE NOT same AND {m.LOW} * positive_score <= 100 * score AND 100 * score <= {m.HIGH} * positive_score)
SELECT anchor AS anchor_id, positive_id, CAST(rank AS INT) AS rank, id AS negative_id, positive_score,
       score AS negative_score
FROM found WHERE rank <= {m.NEGATIVES}"""


def op13_phrases() -> str:
    m = phrases
    grams = " UNION ALL ".join(
        f"SELECT lang, {size} AS size, unnest([array_to_string(w[i:i + {size - 1}], ' ') FOR i IN range(1, len(w) - {size - 2})]) AS phrase "
        f"FROM pieces WHERE len(w) >= {size}" for size in range(1, m.MAX_WORDS + 1))
    cuts = " UNION ALL ".join(
        f"SELECT lang, phrase, a, {k} AS k, array_to_string(w[1:{k}], ' ') AS lhs, array_to_string(w[{k + 1}:], ' ') AS rhs "
        f"FROM candidates WHERE size > {k}" for k in range(1, m.MAX_WORDS))
    return f"""
WITH split AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT lang, [x FOR x IN string_split_regex(piece, '[\x20\x09]+') IF x <> ''] AS w FROM split),
counted AS (SELECT lang, size, phrase, count(*) AS f FROM ({grams}) g GROUP BY ALL),
totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE size > 1 AND f >= {m.MIN_COUNT}),
longer AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, a, unnest([array_to_string(w[1:size - 1], ' '), array_to_string(w[2:], ' ')]) AS phrase
    FROM candidates WHERE size > 2) x GROUP BY ALL),
scored AS (
  SELECT c.lang, c.phrase, a, l.f AS l, r.f AS r, CAST(n AS BIGINT) AS n, k,
         1000 * CAST(a AS HUGEINT) * CAST(n AS HUGEINT) // (CAST(l.f AS HUGEINT) * CAST(r.f AS HUGEINT)) AS score
  FROM ({cuts}) c JOIN totals t ON t.lang = c.lang
  JOIN counted l ON l.lang = c.lang AND l.phrase = c.lhs JOIN counted r ON r.lang = c.lang AND r.phrase = c.rhs),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase
  WHERE g.most IS NULL OR 100 * g.most < {m.COVERED} * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
       CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= {m.PER_LANG}"""


LLM_ORACLE = {f.__name__: f() for f in (
    op3_url_filter, op5_license_scan, op7_quality_rules, op10_secret_scan, op12_hard_negatives, op13_phrases)}
