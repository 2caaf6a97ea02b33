"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from tarmac.llm import importance, license_scan, vector_codes

ORACLE: dict[str, str] = {}

ORACLE["op1_warc_captures"] = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
last AS (SELECT payload_digest, max(page_id) AS response FROM p
         WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN response IS NULL OR response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM p LEFT JOIN last ON p.payload_digest = last.payload_digest AND p.payload_bytes >= 1000
"""

ORACLE["op3_ego_join"] = """
WITH RECURSIVE
v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, len(embedding) AS d,
         sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))) AS norm
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.label = b.label AND a.d = b.d AND a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach(id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other),
comp AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id,
       e.vec_id = component_id AS kept
FROM embeddings e JOIN comp ON comp.id = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""

ORACLE["op4_ngram_jaccard"] = """
WITH RECURSIVE
w AS (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_aggregate(list_slice(ws, i, i + 4), 'string_agg', ' ') AS g
  FROM w, unnest(generate_series(1, greatest(len(ws) - 4, least(len(ws), 1)))) AS t(i)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id
  HAVING 100 * count(*) >= 75 * ((SELECT n FROM n WHERE n.doc_id = x.doc_id)
                                 + (SELECT n FROM n WHERE n.doc_id = y.doc_id) - count(*))),
reach(id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other),
comp AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id
FROM documents d JOIN comp ON comp.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def _license_sql() -> str:
    rows = []
    for k, (name, grams) in enumerate(license_scan.template_rows()):
        lo, hi = license_scan.size_bounds(len(grams))
        items = ", ".join("'" + g + "'" for g in grams)
        rows.append(f"({k}, '{name}', CAST({lo!r} AS DOUBLE), CAST({hi!r} AS DOUBLE), [{items}])")
    seeds = ", ".join(f"('{g}', {k}, {at}, {size})" for g, k, at, size in license_scan.seed_rows())
    return f"""
WITH t(k, name, lo, hi, grams) AS (VALUES {', '.join(rows)}),
seed(gram, k, place, size) AS (VALUES {seeds}),
p AS (SELECT doc_id, row_number() OVER () AS r,
             regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g') AS plain
      FROM documents),
l AS (SELECT r, string_split(plain, chr(10)) AS ls FROM p),
u AS (SELECT r, unnest(ls) AS unit FROM l
      UNION ALL
      SELECT r, list_aggregate(ls, 'string_agg', ' ') FROM l WHERE len(ls) > 1),
x AS (SELECT r, row_number() OVER () AS q,
             list_filter(string_split(unit, ' '), lambda w: w <> '') AS w FROM u),
g AS (SELECT r, q, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams
      FROM x WHERE len(w) > 1),
s AS (SELECT r, q, name, 2.0::DOUBLE * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)) AS dice
      FROM g JOIN t ON len(g.grams) BETWEEN lo AND hi),
b AS (SELECT r, q, max({{'dice': dice, 'name': name}}) AS best FROM s WHERE dice >= {license_scan.DICE} GROUP BY r, q),
tw AS (SELECT r, list_filter(string_split(list_aggregate(ls, 'string_agg', ' '), ' '), lambda w: w <> '') AS w FROM l),
tg AS MATERIALIZED (SELECT r, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS g FROM tw WHERE len(w) > 1),
hit AS (SELECT r, unnest(g) AS gram, unnest(range(len(g))) AS i FROM tg),
st AS (SELECT DISTINCT r, k, size, i - place AS start FROM hit JOIN seed USING (gram)),
win AS (
  SELECT st.r, {{'dice': 2.0::DOUBLE * len(list_intersect(list_distinct(list_slice(g, start + 1, start + size - 1)), t.grams))
         / (len(list_distinct(list_slice(g, start + 1, start + size - 1))) + len(t.grams)), 'name': name}} AS best
  FROM st JOIN tg ON tg.r = st.r JOIN t ON t.k = st.k
  WHERE start >= 0 AND start + size <= len(g) + 1),
every AS (SELECT r, best, 1 AS unit FROM b UNION ALL SELECT r, best, 0 FROM win WHERE best.dice >= {license_scan.DICE}),
d AS (SELECT r, max(best) AS best, sum(unit) AS n_units, sum(1 - unit) AS n_windows,
             list_sort(list_distinct(list(best.name))) AS licenses
      FROM every GROUP BY r)
SELECT doc_id, d.best.name AS license, d.best.dice AS dice, CAST(coalesce(n_units, 0) AS BIGINT) AS n_units,
       CAST(coalesce(n_windows, 0) AS BIGINT) AS n_windows, coalesce(licenses, []) AS licenses
FROM p LEFT JOIN d USING (r)
"""


ORACLE["op6_license_scan"] = _license_sql()

ORACLE["op10_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
m AS (
  SELECT *, lag(role) OVER w AS before,
         replace(replace(replace(text, '\', '\\'), '#', '\#'), '<', '\<') AS esc,
         CASE WHEN role IN ('user', 'system', 'assistant') THEN length(role)
              ELSE 1 + length(replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '<', '\<'), ':', '\:'))
         END AS shown
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(length(esc) + CASE WHEN before = role THEN 8 ELSE 4 + shown + 2 + 9 END) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""


def _codes_sql() -> str:
    parts, entries, rounds = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS
    steps = []
    for k in range(rounds + 1):              # a: nearest entries, b: codebooks moved to the means
        steps.append(f"""
a{k} AS MATERIALIZED (
  SELECT r, p.part, min({entries} * list_sum(list_transform(range(1, len(x) + 1),
                                lambda i: (x[i] - c[i]) * (x[i] - c[i]))) + entry) AS best
  FROM p JOIN b{k} USING (part) GROUP BY r, p.part)""")
        if k < rounds:
            steps.append(f"""
m{k} AS (
  SELECT part, entry, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS c
  FROM (SELECT a.part, CAST(best % {entries} AS BIGINT) AS entry, x, unnest(range(1, len(x) + 1)) AS i
        FROM a{k} a JOIN p USING (r, part)) GROUP BY part, entry, i),
b{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.c, b.c) AS c
  FROM b{k} b LEFT JOIN (SELECT part, entry, list(c ORDER BY i) AS c FROM m{k} GROUP BY part, entry) m
       USING (part, entry))""")
    return f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, len(embedding) // {parts} AS w,
         list_transform(embedding, lambda x: CAST(floor({vector_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT r, part, list_slice(v, part * w + 1, part * w + w) AS x FROM k, range({parts}) AS t(part)),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS c FROM p WHERE r <= {entries}),{','.join(steps)},
f AS (
  SELECT r, string_agg(printf('%02x', CAST(best % {entries} AS BIGINT)), '' ORDER BY part) AS code,
         CAST(sum(best // {entries}) AS BIGINT) AS error
  FROM a{rounds} GROUP BY r),
s AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM k JOIN f USING (r), s
"""


ORACLE["op11_vector_codes"] = _codes_sql()

ORACLE["op12_importance_draw"] = rf"""
WITH tab AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
               CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i))),
w AS MATERIALIZED (
  SELECT 0 AS side, row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
  UNION ALL
  SELECT 1, row_number() OVER (), NULL,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
f AS MATERIALIZED (SELECT side, d, unnest(ws) AS word FROM w),
h AS MATERIALIZED (
  SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM f)),
c AS MATERIALIZED (
  SELECT word, CAST(xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(x) // 2 + 1),
           lambda i: CAST('0x' || substr(x, CAST(2 * i - 1 AS INT), 2) AS BIGINT))),
         lambda r, b: xor(r >> 8, t[CAST(xor(r, b) % 256 + 1 AS INT)])), 4294967295) % {importance.BUCKETS} AS INT) AS bucket
  FROM h, tab),
n AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t
      FROM f JOIN c USING (word) GROUP BY bucket),
total AS (SELECT coalesce(sum(s), 0) AS big, coalesce(sum(t), 0) AS want FROM n),
g AS MATERIALIZED (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (big + {importance.BUCKETS}) AS DOUBLE)
                                      / CAST((s + 1) * (want + {importance.BUCKETS}) AS DOUBLE))) AS BIGINT) AS gain
  FROM n, total),
a AS (
  SELECT d, CAST(count(*) AS BIGINT) AS n_features, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM f JOIN c USING (word) JOIN g USING (bucket) WHERE side = 0 GROUP BY d),
r AS (
  SELECT d, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256(
           '{importance.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
           / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM w LEFT JOIN a USING (d) WHERE side = 0),
k AS (
  SELECT d, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank,
         {importance.PERCENT} * count(*) OVER () // 100 AS many
  FROM r WHERE n_features >= {importance.LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= many THEN rank END AS rank FROM r LEFT JOIN k USING (d)
"""
