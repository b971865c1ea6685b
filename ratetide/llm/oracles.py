"""DuckDB SQL of the operators that SQL can express, written from the contracts
and the rules in the operators' docstrings: plain joins over all windows, lines
or bytes, without fingerprints, filters or shards.

Not here: sharding and SimHash (XXH64), the classifier, HTML extraction and BPE;
tests hold those against brute force or held-out labels.
"""

from __future__ import annotations

import math

from .licences import TEMPLATES, THRESHOLD
from .quality_rules import BOILERPLATE
from .queries import URL_RULES
from .url_filters import Trust

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _item_words(x: str) -> str:
    return f"regexp_extract_all({_LOWER.format(x)}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def licence_scan() -> str:
    known = ", ".join(f"({i}, {_q(s)}, {_q(t)})" for i, (s, t) in enumerate(TEMPLATES))
    pairs = "list_distinct(list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
units AS (
  SELECT r, unnest(list_distinct(list_concat(
    list_transform(string_split(text, chr(10)), lambda x: {_item_words('x')}),
    list_transform(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), lambda x: {_item_words('x')}),
    [{_item_words('text')}]))) AS w
  FROM docs),
sized AS (SELECT r, row_number() OVER () AS u, {pairs.format('w')} AS g FROM units WHERE len(w) BETWEEN 2 AND 2000),
unit_grams AS (SELECT r, u, len(g) AS n, unnest(g) AS gram FROM sized),
known AS (SELECT t, licence, {_item_words('text')} AS w FROM (VALUES {known}) AS k(t, licence, text)),
known_grams AS (SELECT t, licence, len({pairs.format('w')}) AS m, unnest({pairs.format('w')}) AS gram FROM known),
matched AS (
  SELECT r, u, t, licence, 2.0 * count(*) / (n + m) AS dice
  FROM unit_grams JOIN known_grams USING (gram) GROUP BY r, u, t, licence, n, m
  HAVING 2.0 * count(*) / (n + m) >= {THRESHOLD}),
best AS (
  SELECT r, arg_min(licence, (-dice, licence)) AS licence, max(dice) AS dice,
         string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences, count(DISTINCT u) AS n_matches
  FROM matched GROUP BY r)
SELECT doc_id, licence, round(dice, 6) AS dice, coalesce(licences, '') AS licences, coalesce(n_matches, 0) AS n_matches
FROM docs LEFT JOIN best USING (r)"""


DECONTAMINATION = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_item_words("coalesce(text, '')")} AS w FROM documents),
items AS (SELECT item_id, {_item_words("coalesce(text, '')")} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS k FROM items WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized)),
doc_windows AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM docs CROSS JOIN (SELECT DISTINCT k FROM sized) WHERE len(w) >= k)),
hits AS (SELECT r, k, i, item_id FROM doc_windows JOIN item_windows USING (k, s)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
found AS (SELECT r, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
          FROM hits GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)"""


QUALITY_RULES = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM docs),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS times
  FROM (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM worded WHERE len(w) > 2))),
repeats AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE times > 1) GROUP BY r),
lines AS (
  SELECT r, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)),
judged AS (
  SELECT r, line, n,
         100 * len(regexp_extract_all(line, '[#*$%&|<>]')) > 20 * n
      OR 100 * len(regexp_extract_all(line, '[!?¡¿]')) > 30 * n + 100
      OR 100 * len(regexp_extract_all(line, '[|»›•·→]')) > 25 * n
      OR (n >= 4 AND upper(line) = line AND lower(line) <> line)
      OR (n >= 60 AND NOT regexp_matches(line, '[.!?…。]'))
      OR (n <= 25 AND regexp_matches(lower(line), {_q(BOILERPLATE)})) AS fails
  FROM lines WHERE n > 0),
by_line AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (fails) AS n_failed_lines,
         coalesce(sum(n) FILTER (fails), 0) AS n_lost_words
  FROM judged GROUP BY r),
facts AS (
  SELECT doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_failed_lines, 0) AS n_failed_lines,
         coalesce(n_lost_words, 0) AS n_lost_words
  FROM worded LEFT JOIN repeats USING (r) LEFT JOIN by_line USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_failed_lines,
       CAST(n_lost_words AS BIGINT) AS n_lost_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND 100 * n_lost_words <= 30 * n_words AS kept
FROM facts"""


def url_filters() -> str:
    t = Trust()
    rules = ", ".join(f"({_q(v)}, {_q(s)}, {_q(s.partition('/')[0])}, {_q('/' + s.partition('/')[2])})" for v, s in URL_RULES)
    lower = _LOWER.format("{0}")
    steps = []
    # rounds: until a change is below the tolerance, and as many as a path can be long
    settled = math.ceil(math.log(t.tolerance / 2) / math.log(t.damping)) + 1
    for name, verdict, src, dst, share in (("trust", "allowed", "src", "dst", "share"), ("distrust", "blocked", "dst", "src", "back_share")):
        steps.append(f"""{name}_seed AS (
  SELECT host FROM hosts WHERE {verdict} >= {t.seed_share}
  UNION ALL SELECT host FROM linked WHERE {verdict} >= {t.seed_share}
    AND host NOT IN (SELECT host FROM hosts WHERE allowed >= {t.seed_share} OR blocked >= {t.seed_share})),
{name}_rounds AS (
  SELECT 0 AS n, host, 1.0::DOUBLE AS score FROM {name}_seed
  UNION ALL
  SELECT n, host, sum(score) FROM (
    SELECT n + 1 AS n, links.{dst} AS host, {t.damping} * score * links.{share} AS score
    FROM {name}_rounds JOIN links ON {name}_rounds.host = links.{src}
    UNION ALL
    SELECT n + 1, {name}_seed.host, {1 - t.damping} FROM {name}_seed JOIN {name}_rounds ON {name}_seed.host = {name}_rounds.host)
  WHERE n <= {settled} + (SELECT count(DISTINCT src) FROM links) GROUP BY n, host),
{name} AS (SELECT host, score FROM {name}_rounds WHERE n = (SELECT max(n) FROM {name}_rounds))""")
    return f"""
WITH RECURSIVE parsed AS (
  SELECT row_number() OVER () AS r, page_id, html,
         {lower.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
rules(verdict, rule, name, prefix) AS (VALUES {rules}),
fitting AS (
  SELECT r, arg_max(rule, len(rule)) AS rule, arg_max(verdict, len(rule)) AS verdict
  FROM parsed JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, prefix) GROUP BY r),
ruled AS (SELECT parsed.*, rule, verdict FROM parsed LEFT JOIN fitting USING (r)),
hosts AS (SELECT host, avg(CASE WHEN verdict = 'allow' THEN 1.0 ELSE 0 END) AS allowed,
                 avg(CASE WHEN verdict = 'block' THEN 1.0 ELSE 0 END) AS blocked FROM ruled GROUP BY host),
hrefs AS (
  SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''),
    '(?i)\\shref\\s*=\\s*["'']?\\s*((?:[a-z][a-z0-9+.-]*:)?//[^"''\\s>]+)', 1)) AS url FROM ruled),
counted AS (
  SELECT src, dst, count(*) AS n, count(DISTINCT r) FILTER (verdict = 'allow') AS allowed, count(DISTINCT r) FILTER (verdict = 'block') AS blocked
  FROM (SELECT r, src, dst, arg_max(verdict, len(rule)) AS verdict FROM (
      SELECT row_number() OVER () AS r, src, {lower.format("regexp_extract(url, '//([^/?#]*)', 1)")} AS dst,
             regexp_extract(url, '//[^/?#]*([^?#]*)', 1) AS path FROM hrefs) h
    LEFT JOIN rules ON (dst = name OR ends_with(dst, '.' || name)) AND starts_with(path, prefix)
    WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY r, src, dst)
  GROUP BY src, dst),
links AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS share, n / sum(n) OVER (PARTITION BY dst) AS back_share FROM counted),
linked AS (SELECT dst AS host, sum(allowed) / sum(n) AS allowed, sum(blocked) / sum(n) AS blocked FROM counted GROUP BY dst),
{(", ".join(steps))}
SELECT page_id, host, path, rule, coalesce(verdict, CASE
         WHEN coalesce(d.score, 0) > {t.threshold} * coalesce(t.score, 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN trust t USING (host) LEFT JOIN distrust d USING (host)"""


SUFFIX_DEDUP = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT r, doc_id, i, substr(h, 2 * i + 1, 100) AS s
  FROM (SELECT r, doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM docs WHERE len(h) >= 100 AND doc_id IS NOT NULL)),
first AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 50)) AS i FROM windows JOIN first USING (s) WHERE least < doc_id),
spans AS (SELECT r, count(*) AS n_removed, count(*) FILTER (i - 1 IS DISTINCT FROM before) AS n_spans
          FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM gone) GROUP BY r),
bytes AS (SELECT r, h, unnest(range(0, len(h) // 2)) AS i FROM docs),
kept AS (SELECT r, string_agg(substr(h, 2 * i + 1, 2), '' ORDER BY i) AS h
         FROM bytes ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(docs.h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept.h, ''))) AS kept_sha256
FROM docs LEFT JOIN spans USING (r) LEFT JOIN kept USING (r)"""

PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, unnest(w) AS a, unnest(w[2:]) AS b, unnest(w[3:]) AS c FROM words),
one AS (SELECT lang, a, count(*) AS f FROM places WHERE a IS NOT NULL GROUP BY ALL),
two AS (SELECT lang, a, b, count(*) AS f FROM places WHERE b IS NOT NULL GROUP BY ALL),
three AS (SELECT lang, a, b, c, count(*) AS f FROM places WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM one GROUP BY lang),
cuts AS (
  SELECT t.lang, t.a || ' ' || t.b AS phrase, 1 AS cut, t.f AS a, l.f AS l, r.f AS r
  FROM two t JOIN one l ON l.lang = t.lang AND l.a = t.a JOIN one r ON r.lang = t.lang AND r.a = t.b
  WHERE t.f >= 10
  UNION ALL
  SELECT t.lang, t.a || ' ' || t.b || ' ' || t.c, 1, t.f, l.f, r.f
  FROM three t JOIN one l ON l.lang = t.lang AND l.a = t.a JOIN two r ON r.lang = t.lang AND r.a = t.b AND r.b = t.c
  UNION ALL
  SELECT t.lang, t.a || ' ' || t.b || ' ' || t.c, 2, t.f, l.f, r.f
  FROM three t JOIN two l ON l.lang = t.lang AND l.a = t.a AND l.b = t.b JOIN one r ON r.lang = t.lang AND r.a = t.c),
scored AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
           QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (SELECT lang, phrase, max(f) AS f
           FROM (SELECT lang, a || ' ' || b AS phrase, f FROM three UNION ALL SELECT lang, b || ' ' || c, f FROM three)
           GROUP BY ALL),
kept AS (SELECT s.* FROM scored s LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase
         WHERE g.f IS NULL OR 100 * g.f < 50 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

ORACLE_SQL: dict[str, str] = {
    "op1_licence_scan": licence_scan(),
    "op2_decontamination": DECONTAMINATION,
    "op5_quality_rules": QUALITY_RULES,
    "op6_url_filters": url_filters(),
    "op8_suffix_dedup": SUFFIX_DEDUP,
    "op11_phrases": PHRASES,
}
