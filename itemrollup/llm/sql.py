"""DuckDB SQL of the operators that SQL can express over whole tables."""

from __future__ import annotations

from .url_filter import ALLOW_GLOBS, BLOCK_GLOBS, RULES


def _regex(glob: str) -> str:
    """The glob as a regular expression (the registered globs use literals, ``*`` and ``**`` only)."""
    parts = glob.replace("**", "\0").replace(".", "[.]").replace("*", "[^/?]*").replace("\0", "(.|\n)*")
    return f"'^{parts}$'"


def url_filter() -> str:
    rules = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)
    matches = lambda globs: " OR ".join(f"regexp_matches(canonical, {_regex(g)})" for g in globs)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH rules(verdict, host, path) AS (VALUES {rules}),
rest AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{upper}', '{upper.lower()}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\\?[^#]*)', 1) AS query
  FROM rest),
judged AS (
  SELECT page_id, p.host, p.path, p.host || p.path || p.query AS canonical,
    (SELECT max(struct_pack(n := length(r.host || r.path), rule := r.host || r.path, verdict := r.verdict)) FROM rules r
     WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS best
  FROM parts p)
SELECT page_id, host, path, best.rule AS rule,
  CASE WHEN best IS NOT NULL THEN best.verdict WHEN {matches(ALLOW_GLOBS)} THEN 'allow'
       WHEN {matches(BLOCK_GLOBS)} THEN 'block' ELSE 'allow' END AS verdict
FROM judged"""


FILTER_AUDIT = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS first_id FROM texts),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
failing AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
     100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
     regexp_matches(text, '[#$%&*|]'), coalesce(words.doc_id > first_id, false)] AS fails
  FROM words LEFT JOIN marks USING (doc_id)),
counted AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic,
    len([x FOR x IN fails IF x]) AS n_fails FROM failing GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step FROM orders, range(1, 6) t(step)),
hits AS (
  SELECT part, filter_order, step, n, good, toxic, n_fails,
    fails[ascii(substr(filter_order, step, 1)) - 64] AS here,
    len([i FOR i IN range(1, step) IF fails[ascii(substr(filter_order, CAST(i AS INTEGER), 1)) - 64]]) > 0 AS gone
  FROM counted, steps),
summed AS (
  SELECT part, filter_order, step,
    coalesce(sum(n) FILTER (NOT gone AND NOT here), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND here), 0) AS removed,
    coalesce(sum(n) FILTER (gone AND here), 0) AS redundant, coalesce(sum(n) FILTER (here AND n_fails = 1), 0) AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND here), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND here), 0) AS toxic_lost
  FROM hits GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)) AS BIGINT) AS shapley
FROM summed"""


COLLOCATIONS = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_extract_all(text, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM texts),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, m, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS phrase
  FROM worded, range(1, 5) t(m) WHERE len(w) >= m),
f AS (SELECT lang, CAST(m AS BIGINT) AS m, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, m, phrase),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
often AS (SELECT * FROM f WHERE a >= 30),
cuts AS (SELECT lang, m, phrase, a, w, unnest(range(1, m)) AS k FROM often WHERE m > 1),
scored AS (
  SELECT c.lang, c.m, c.phrase, c.a, c.k, x.a AS l, y.a AS r, CAST(2000000 * CAST(c.a AS HUGEINT) // (x.a + y.a) AS BIGINT) AS score
  FROM cuts c JOIN often x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN often y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')),
best AS (SELECT lang, m, phrase, a, min(struct_pack(score := score, k := k, l := l, r := r)) AS c FROM scored GROUP BY lang, m, phrase, a),
spans AS (SELECT lang, a, w, m, unnest(range(2, m)) AS size FROM often WHERE m > 2),
inner_spans AS (SELECT lang, a, w, size, unnest(range(1, m - size + 2)) AS i FROM spans),
around AS (SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS most FROM inner_spans GROUP BY 1, 2),
kept AS (
  SELECT b.lang, b.phrase, b.a, b.c.l AS l, b.c.r AS r, b.c.score AS score
  FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.phrase = b.phrase WHERE o.most IS NULL OR 100 * o.most < 80 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


DECONTAMINATION = r"""
WITH lowered AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
    unnest([array_to_string(w[i:i + least(10, len(w)) - 1], ' ') FOR i IN range(1, len(w) - least(10, len(w)) + 2)]) AS phrase
  FROM items WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
starts AS (
  SELECT rid, size, unnest(range(1, len(w) - size + 2)) AS i,
    unnest([array_to_string(w[i:i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS phrase
  FROM lowered, sizes WHERE len(w) >= size),
hits AS (SELECT rid, i, size, item_id FROM starts JOIN windows USING (size, phrase)),
words AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS pos FROM hits) GROUP BY rid),
named AS (
  SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered LEFT JOIN words USING (rid) LEFT JOIN named USING (rid)"""


SUBSTRING_DEDUP = r"""
WITH words AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, rid, unnest(range(1, len(w) - 48)) AS i, unnest([sha256(array_to_string(w[i:i + 49], ' ')) FOR i IN range(1, len(w) - 48)]) AS h
  FROM words WHERE len(w) >= 50),
first AS (SELECT h, min(doc_id) AS lowest FROM starts GROUP BY h HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT rid, unnest(range(i, i + 50)) AS pos FROM starts JOIN first USING (h) WHERE doc_id > lowest),
gone AS (SELECT rid, list(pos) AS gone FROM covered GROUP BY rid),
each AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM words WHERE rid IN (SELECT rid FROM gone)),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY pos) AS kept FROM each ANTI JOIN covered USING (rid, pos) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
  sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE coalesce(kept, '') END) AS kept_sha256
FROM words LEFT JOIN gone USING (rid) LEFT JOIN kept USING (rid)"""


ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": DECONTAMINATION,
    "op4_substring_dedup": SUBSTRING_DEDUP,
    "op11_url_filter": url_filter(),
    "op12_filter_audit": FILTER_AUDIT,
    "op13_collocations": COLLOCATIONS,
}
