"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tallyframe.llm.common import plain_words
from tallyframe.llm.license_join import PHRASES, TEMPLATES

CHECKS: dict[str, str] = {}

CHECKS["op4_suffix_automaton"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words,
    row_number() OVER () AS r FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bw AS (
  SELECT DISTINCT item, least(len(words), 10) AS n, array_to_string(words[p : p + least(len(words), 10) - 1], ' ') AS gram
  FROM (SELECT item, words, unnest(generate_series(1, greatest(len(words) - 9, 1))) AS p FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, p, n, array_to_string(words[p : p + n - 1], ' ') AS gram
  FROM (SELECT r, words, n, unnest(generate_series(1, len(words) - n + 1)) AS p FROM d, sizes WHERE len(words) >= n)),
m AS (SELECT dw.r, dw.p, dw.n, bw.item FROM dw JOIN bw ON dw.gram = bw.gram AND dw.n = bw.n),
h AS (SELECT r, count(DISTINCT w) AS n_hit FROM (SELECT r, unnest(generate_series(p, p + n - 1)) AS w FROM m) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
  sha256(coalesce(i.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON h.r = d.r LEFT JOIN i ON i.r = d.r
"""


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _license_sql() -> str:
    """Every window of every text against every template by plain set operations, without the filters of the join."""
    words = lambda text: (
        f"list_filter(regexp_split_to_array(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
    )
    size = max(len(plain_words(t.encode())) for t in TEMPLATES)
    templates = ", ".join(
        f"({k}, '{label}', {_list(sorted({w.decode() for w in plain_words(t.encode())}))})"
        for k, (t, label) in enumerate(TEMPLATES.items())
    )
    phrases = ", ".join(f"('{label}', {_list(p.split())})" for p, label in PHRASES.items())
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, {words('t')} AS words FROM d),
p(label, ws) AS (VALUES {phrases}),
places AS (
  SELECT r, label, i - 1 AS start FROM (SELECT r, words, unnest(generate_series(1, len(words))) AS i FROM w), p
  WHERE words[i] = ws[1] AND words[i : i + len(ws) - 1] = ws),
base AS (
  SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY r),
cut AS (
  SELECT r, words[i + 1 : i + {2 * size}] AS block FROM (
    SELECT r, words, unnest(range(0, greatest(len(words) - {size}, least(len(words), 1)), {size})) AS i FROM w)),
b AS (SELECT row_number() OVER () AS id, r, block FROM cut),
t(k, label, ws) AS (VALUES {templates}),
m AS (
  SELECT id, r, k, label, len(ws) AS n, list_intersect(ws, block) AS own FROM b, t
  WHERE len(list_intersect(ws, block)) >= ceil(0.85 * len(ws) - 1e-9)),
best AS (
  SELECT id, r, label, len(own) / n AS share FROM m
  WHERE NOT EXISTS (SELECT 1 FROM m AS o WHERE o.id = m.id AND o.k <> m.k AND list_has_all(o.own, m.own)
    AND (len(o.own) > len(m.own) OR (len(o.own) / o.n, o.n, -o.k) > (len(m.own) / m.n, m.n, -m.k)))),
found AS (SELECT r, max(share) AS score, count(DISTINCT id) AS n_blocks FROM best GROUP BY r),
named AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM places UNION SELECT r, label FROM best) GROUP BY r)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score,
  coalesce(n_blocks, 0) AS n_blocks
FROM w LEFT JOIN base USING (r) LEFT JOIN found USING (r) LEFT JOIN named USING (r)
"""


CHECKS["op3_license_join"] = _license_sql()

CHECKS["op11_length_bucketed_crc"] = r"""
WITH crc(t) AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))),
w AS (
  SELECT false AS target, row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents
  UNION ALL
  SELECT true, NULL, NULL, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')
  FROM benchmark),
g AS (
  SELECT target, r, unnest(words) AS gram FROM w
  UNION ALL
  SELECT target, r, words[p] || ' ' || words[p + 1] FROM (SELECT *, unnest(range(1, len(words))) AS p FROM w)),
n AS (SELECT target, r, gram, count(*) AS n FROM g GROUP BY ALL),
h AS (SELECT gram, hex(encode(gram)) AS x FROM (SELECT DISTINCT gram FROM n)),
b AS (
  SELECT gram, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(x) // 2), lambda i:
      16 * (instr('0123456789ABCDEF', x[2 * i + 1]) - 1) + instr('0123456789ABCDEF', x[2 * i + 2]) - 1)),
    lambda c, y: xor(c // 256, t[xor(c % 256, y) + 1])), 4294967295) % 10000 AS bucket FROM h, crc),
c AS (
  SELECT k.bucket, coalesce(sum(n) FILTER (NOT target), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (target), 0)::DOUBLE AS t
  FROM (SELECT unnest(range(10000)) AS bucket) k LEFT JOIN (n JOIN b USING (gram)) USING (bucket) GROUP BY 1),
q AS (SELECT sum(s) AS s, sum(t) AS t FROM c),
gain AS (SELECT bucket, floor(1000 * ln((c.t + 1) * (q.s + 10000) / ((c.s + 1) * (q.t + 10000))))::BIGINT AS gain FROM c, q),
d AS (
  SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
  FROM n JOIN b USING (gram) JOIN gain USING (bucket) WHERE NOT target GROUP BY 1),
s AS (
  SELECT w.r, w.doc_id, len(words) >= 20 AS able, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((list_reduce(list_prepend(0::BIGINT, list_transform(range(8), lambda i:
      (instr('0123456789abcdef', substr(sha256('7:' || coalesce(w.doc_id::VARCHAR, '')), i + 1, 1)) - 1)::BIGINT)),
      lambda a, y: a * 16 + y) + 0.5) / 4294967296)))::BIGINT AS score
  FROM w LEFT JOIN d USING (r) WHERE NOT target),
o AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER (PARTITION BY able) AS m FROM s)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 25 * m // 100 THEN place END AS rank FROM o
"""

CHECKS["op12_induced_suffixes"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (
  SELECT r, p, md5_number(substr(x, 2 * p + 1, 400)) AS h
  FROM (SELECT *, unnest(range(0, len(x) // 2 - 199)) AS p FROM d WHERE len(x) >= 400)),
m AS (SELECT r, p FROM s WHERE h IN (SELECT h FROM s GROUP BY h HAVING count(*) > 1)),
i AS (SELECT *, p - lag(p) OVER (PARTITION BY r ORDER BY p) AS gap FROM m),
g AS (SELECT r, p, sum(CASE WHEN gap <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS run FROM i),
c AS (SELECT r, run, min(p) AS f, max(p) + 200 AS t FROM g GROUP BY 1, 2),
kept AS (
  SELECT r, string_agg(part, '' ORDER BY f) AS x FROM (
    SELECT d.r, f, substr(x, 2 * coalesce(lag(t) OVER (PARTITION BY d.r ORDER BY f), 0) + 1,
      2 * (f - coalesce(lag(t) OVER (PARTITION BY d.r ORDER BY f), 0))) AS part FROM c JOIN d USING (r)
    UNION ALL
    SELECT d.r, 1e18, substr(x, 2 * t + 1) FROM d JOIN (SELECT r, max(t) AS t FROM c GROUP BY 1) USING (r)) GROUP BY 1),
n AS (SELECT r, sum(t - f)::BIGINT AS n_removed, count(*) AS n_spans FROM c GROUP BY 1)
SELECT doc_id, len(d.x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept.x, d.x))) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN kept USING (r)
"""

CHECKS["op13_pattern_tree"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, lang, source, unnest(list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3),
langs AS (
  SELECT lang, count(term)::HUGEINT AS v, coalesce(sum(n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY 1),
counts AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
groups AS (
  SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN counts USING (lang, source) GROUP BY 1, 2),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + l.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // y.p), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  WHERE x.term IS NULL OR y.term IS NOT NULL GROUP BY 1, 2, 3),
terms AS (SELECT lang, source, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT 'pair' AS part, * FROM pairs UNION ALL SELECT 'term', * FROM terms))
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
