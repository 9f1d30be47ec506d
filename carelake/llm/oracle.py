"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from carelake.llm.quality_rules import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS

_WHITE = r"[\x20\x09-\x0D]"


def _quality() -> str:
    stops = ", ".join("'" + w + "'" for w in sorted(set(STOP_WORDS)))
    bounds = [f"{r.measure} >= {r.low}" for r in RULES if r.low is not None]
    bounds += [f"{r.measure} <= {r.high}" for r in RULES if r.high is not None]
    return rf"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
parts AS (
  SELECT doc_id, body,
         list_filter(regexp_split_to_array(body, '{_WHITE}+'), lambda w: w <> '') AS ws,
         list_filter(string_split(body, chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM doc),
spots AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM parts),
grams AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM spots),
twice AS (SELECT doc_id, g FROM grams GROUP BY doc_id, g HAVING count(*) > 1),
marked AS (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams JOIN twice USING (doc_id, g)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM marked GROUP BY doc_id),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, len(array_to_string(ws, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines,
         len(list_filter(ws, lambda w: lower(w) IN ({stops}))) AS n_stop
  FROM parts LEFT JOIN rep USING (doc_id)),
r AS (
  SELECT *, CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words ELSE 0 END AS mean_word_length,
         CASE WHEN word_chars > 0 THEN n_symbols::DOUBLE / word_chars ELSE 0 END AS symbol_ratio,
         CASE WHEN n_words > 0 THEN n_stop::DOUBLE / n_words ELSE 0 END AS stop_word_ratio,
         CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END AS dup_line_ratio,
         n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed) AND {" AND ".join(bounds)} AS kept
FROM r"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lines() -> str:
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (
  SELECT doc_id, i, ls[i] AS line, translate(trim(ls[i], {white}), '{_UPPER}', '{_LOWER}') AS k
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM cut)),
held AS (
  SELECT k, max(doc_id) AS top FROM lines WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT l.doc_id, i, line, h.k IS NOT NULL AND l.doc_id <> h.top AS gone
  FROM lines l LEFT JOIN held h ON l.k = h.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


def _revisits() -> str:
    return """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest)
                     ELSE page_id END AS f FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN f = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f <> page_id THEN f END AS refers_to FROM f"""


def _filters() -> str:
    letters = ", ".join(f"('{x}')" for x in "ABCDE")
    steps = "\n  UNION ALL ".join(
        f"SELECT filter_order, {i} AS step, filter_order[{i}] AS own, filter_order[1:{i - 1}] AS before FROM orders" if i > 1 else
        "SELECT filter_order, 1 AS step, filter_order[1] AS own, '' AS before FROM orders" for i in range(1, 6))
    fails = " || ".join(f"CASE WHEN {x.lower()} THEN '{x}' ELSE '' END" for x in "ABCDE")
    return rf"""
WITH doc AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body FROM documents),
words AS (
  SELECT *, list_filter(regexp_split_to_array(body, '{_WHITE}+'), lambda w: w <> '') AS ws,
         min(doc_id) OVER (PARTITION BY body) AS first FROM doc),
judged AS (
  SELECT doc_id, part, len(ws) < 50 AS a, 100 * len(list_distinct(ws)) < 65 * len(ws) AS b,
         100 * len(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * len(body) AS c,
         regexp_matches(body, '[#$%&*|]') AS d, coalesce(doc_id > first, false) AS e FROM words),
lab AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
docs AS (
  SELECT part, {fails} AS fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM judged LEFT JOIN lab USING (doc_id)),
groups AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS n_good,
         count(*) FILTER (WHERE toxic) AS n_toxic FROM docs GROUP BY part, fails),
letter(x) AS (VALUES {letters}),
orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
  FROM letter p JOIN letter q ON q.x <> p.x JOIN letter r ON r.x NOT IN (p.x, q.x)
  JOIN letter s ON s.x NOT IN (p.x, q.x, r.x) JOIN letter t ON t.x NOT IN (p.x, q.x, r.x, s.x)),
steps AS (
  {steps}),
seen AS (
  SELECT part, filter_order, step, own, n, n_good, n_toxic, fails, contains(fails, own) AS fails_own,
         before <> '' AND translate(fails, before, '') <> fails AS fails_before
  FROM groups JOIN steps ON true),
rows AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (WHERE NOT fails_own AND NOT fails_before), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE fails_own AND NOT fails_before), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE fails_own AND fails_before), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE fails = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(n_good) FILTER (WHERE fails_own AND NOT fails_before), 0)::BIGINT AS good_lost,
         coalesce(sum(n_toxic) FILTER (WHERE fails_own AND NOT fails_before), 0)::BIGINT AS toxic_lost
  FROM seen GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM rows"""


def _ranked() -> str:
    terms = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {terms} AS ts FROM documents),
size AS (SELECT r, doc_id, len(ts)::BIGINT AS n FROM doc WHERE len(ts) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM size),
held AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS t FROM doc) GROUP BY r, t),
asked AS (
  SELECT q, t, count(*)::BIGINT AS times
  FROM (SELECT row_number() OVER () AS q, unnest({terms}) AS t FROM benchmark) GROUP BY q, t),
item AS (SELECT row_number() OVER () AS q, item_id FROM benchmark),
freq AS (SELECT t, count(*)::BIGINT AS df FROM held GROUP BY t),
weight AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM freq, total),
norm AS (SELECT r, doc_id, 100 - 25 + ((25 * n * docs) // terms) AS m FROM size, total),
found AS (
  SELECT q, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN held USING (t) JOIN weight USING (t) JOIN norm USING (r) GROUP BY q, r),
ranked AS (
  SELECT q, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM found JOIN norm USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked JOIN item USING (q) WHERE rank <= 20"""


def build() -> dict[str, str]:
    return {"op12_treap_search": _ranked(), "op13_filter_audit": _filters(), "op3_line_dedup": _lines(), "op8_warc_zip": _revisits(), "op6_quality_rules": _quality()}
