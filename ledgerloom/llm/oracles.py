"""DuckDB SQL over whole tables for the queries that SQL can express."""

from __future__ import annotations

from ledgerloom.llm.secrets import BASE_RULES, RULES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Shingle sets, pairs by common shingles, and components by spreading the smallest id.
NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 2 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) WHEN len(ws) = 1 THEN ws ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS same FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * same >= 80 * (x.n + y.n - same)),
b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT b.v, r.root FROM r JOIN b ON b.u = r.doc_id WHERE r.root < b.v),
m AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, m.component_id = d.doc_id AS kept
FROM documents d JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)"""

TOP_K = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.row, q.vec_id AS query_id, k.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.v, k.v), lambda z: CAST(z[1] AS HUGEINT) * z[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v k ON q.row <> k.row AND q.vec_id % 50 = 0 AND len(q.v) = len(k.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def secret_scan() -> str:
    found = []
    for k, rule in enumerate(RULES):
        p = _quoted(rule.pattern)
        found.append(
            f"SELECT row, {k} AS k, {_quoted(rule.kind)} AS kind, {rule.least} AS least, string_split_regex(t, {p}) AS gaps, "
            f"regexp_extract_all(t, {p}, 0) AS found, regexp_extract_all(t, {p}, {rule.group}) AS part FROM d WHERE regexp_matches(t, {p})"
        )
    counts = ", ".join(f"count(*) FILTER (kind = {_quoted(r.kind)}) AS n_{r.kind}" for r in BASE_RULES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(found)}),
i AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM f),
s AS (
  SELECT row, k, kind, length(part[i]) AS size, least,
    CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS a, length(found[i]) AS n FROM i),
h AS (SELECT row, k, kind, a, kind || ':' || a || ':' || (a + n) AS span FROM s WHERE size >= least),
g AS (
  SELECT row, {counts}, string_agg(span, ',' ORDER BY a, k) FILTER (k < {len(BASE_RULES)}) AS base, string_agg(span, ',' ORDER BY a, k) AS spans FROM h GROUP BY 1)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (row)"""


#: CRC-32 byte by byte with its table of 256 steps; near words share a text with one letter hidden, or are another less one letter.
SPELLING = rf"""
WITH RECURSIVE c AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS steps),
d AS (SELECT row_number() OVER () AS row, doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
u AS (SELECT row, doc_id, unnest(regexp_extract_all(t, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM d),
r AS (SELECT row, doc_id, run, count(*) AS n, hex(encode(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', run))) AS h FROM u WHERE length(run) >= 5 GROUP BY ALL),
b AS (SELECT run, n, list_transform(range(1, length(h) // 2 + 1), lambda i: CAST(concat('0x', substr(h, 2 * i - 1, 2)) AS BIGINT)) AS bytes FROM r),
x AS (SELECT run, n, xor(list_reduce(bytes, lambda a, k: xor(steps[(xor(a, k) & 255) + 1], a >> 8), CAST(4294967295 AS BIGINT)), 4294967295) AS crc FROM b, c),
w AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN crc % 97 = 0 THEN concat(left(run, CAST(crc % length(run) AS BIGINT)), substr(run, CAST(crc % length(run) AS BIGINT) + 2)) ELSE run END AS word, n FROM x)
  WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
i AS MATERIALIZED (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w),
hidden AS MATERIALIZED (SELECT word, concat(left(word, i - 1), '?', substr(word, i + 1)) AS k FROM i),
less AS (SELECT DISTINCT word, concat(left(word, i - 1), substr(word, i + 1)) AS k FROM i),
p AS (
  SELECT a.word, o.word AS other FROM hidden a JOIN hidden o ON a.k = o.k AND a.word <> o.word
  UNION SELECT less.word, w.word FROM less JOIN w ON less.k = w.word UNION SELECT w.word, less.word FROM less JOIN w ON less.k = w.word),
q AS (SELECT p.word, count(*) AS n_near, max(o.n) AS top, min({{'less': -o.n, 'word': o.word}}) AS best FROM p JOIN w o ON o.word = p.other GROUP BY 1),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * w.n THEN best.word END AS form, CASE WHEN top >= 2 * w.n THEN top END AS form_n FROM w LEFT JOIN q USING (word)),
chain AS (SELECT word, word AS root FROM f UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.root WHERE f.form IS NOT NULL),
last AS (SELECT chain.word, chain.root FROM chain JOIN f ON f.word = chain.root WHERE f.form IS NULL)
SELECT f.word, f.form, last.root, f.n, f.n_near, f.form_n FROM f JOIN last USING (word)"""
