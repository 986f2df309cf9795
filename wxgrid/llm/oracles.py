"""DuckDB SQL of the operators that SQL can express."""

OP3 = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT *, least(10, len(w)) AS n FROM iw WHERE len(w) > 0))),
sizes AS (SELECT DISTINCT n FROM win),
dg AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, dg.n, i, item_id FROM dg JOIN win ON dg.g = win.g AND dg.n = win.n),
words AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5 = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
f AS (SELECT k.doc_id, i, line, r.key IS NOT NULL AND k.doc_id < top AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""

OP7 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, i, w[i] AS g1, CASE WHEN i > 1 THEN w[i - 1] || ' ' || w[i] END AS g2, CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] || ' ' || w[i] END AS g3
      FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
c AS (SELECT t.r, i, g2 IS NOT NULL AS has2, g3 IS NOT NULL AS has3,
      count(*) OVER (PARTITION BY g1) - count(*) OVER (PARTITION BY t.r, g1) AS c1,
      count(*) OVER (PARTITION BY g2) - count(*) OVER (PARTITION BY t.r, g2) AS c2,
      count(*) OVER (PARTITION BY g3) - count(*) OVER (PARTITION BY t.r, g3) AS c3,
      greatest(count(*) OVER () - count(*) OVER (PARTITION BY t.r), 1) AS rest FROM t),
x AS (SELECT *, greatest(lag(c1) OVER w, 1) AS p1, greatest(lag(c2) OVER w, 1) AS p2 FROM c WINDOW w AS (PARTITION BY r ORDER BY i)),
y AS (SELECT r, CASE WHEN has3 AND c3 > 0 THEN 0 WHEN has2 AND c2 > 0 THEN CAST(has3 AS INT) ELSE CAST(has2 AS INT) END AS back,
      CASE WHEN has3 AND c3 > 0 THEN log10(c3 / p2)
           ELSE CASE WHEN has3 THEN log10(0.4) ELSE 0 END +
                CASE WHEN has2 AND c2 > 0 THEN log10(c2 / p1)
                     ELSE CASE WHEN has2 THEN log10(0.4) ELSE 0 END + log10(CASE WHEN c1 > 0 THEN c1 ELSE 0.4 END / rest) END END AS z FROM x),
s AS (SELECT r, sum(back) AS n_backoff, sum(z) AS z FROM y GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_backoff, 0) AS BIGINT) AS n_backoff, round(z, 4) AS log10_score, round(z / len(w), 6) AS mean_log10
FROM d LEFT JOIN s USING (r)
"""

OP8 = r"""
WITH RECURSIVE dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM dw WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * o >= 80 * (p.n + q.n - o)),
e AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (SELECT x AS doc_id, x AS r FROM e UNION SELECT reach.doc_id, e.y FROM reach JOIN e ON e.x = reach.r)
SELECT dw.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce((SELECT min(r) FROM reach WHERE reach.doc_id = dw.doc_id), dw.doc_id) AS component_id
FROM dw LEFT JOIN n ON n.doc_id = dw.doc_id
"""

#: Byte positions as pairs of hexadecimal digits.
OP10 = r"""
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
p AS (SELECT doc_id, i, x[2 * i + 1:2 * i + 100] AS g FROM (SELECT doc_id, x, unnest(range(0, greatest(length(x) // 2 - 49, 0))) AS i FROM d)),
m AS (SELECT g, min(doc_id) AS top FROM p GROUP BY g),
hit AS (SELECT doc_id, i FROM p JOIN m USING (g) WHERE top < doc_id),
run AS (SELECT doc_id, i, coalesce(i > lag(i) OVER w + 50, true) AS head FROM hit WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
grp AS (SELECT doc_id, i, sum(CAST(head AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM run),
span AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM grp GROUP BY doc_id, k),
gap AS (SELECT doc_id, k, a, b, coalesce(lag(b) OVER w, 0) AS before, lead(a) OVER w IS NULL AS final FROM span WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
s AS (SELECT d.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
      string_agg(x[2 * before + 1:2 * a] || CASE WHEN final THEN substr(x, 2 * b + 1) ELSE '' END, '' ORDER BY k) AS kept
      FROM gap JOIN d USING (doc_id) GROUP BY d.doc_id)
SELECT d.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)
"""

#: Base 32 from five hexadecimal digits at a time.
OP11 = r"""
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n, sha1(coalesce(html, '')) AS h FROM pages),
t AS (SELECT h, n, max(page_id) AS top FROM p GROUP BY h, n)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(8), lambda i: list_reduce(list_transform(range(4),
           lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || h[5 * i + 1:5 * i + 5] AS BIGINT) >> (15 - 5 * j)) & 31)::INT + 1, 1)),
           lambda a, b: a || b)), '') AS payload_digest,
       CASE WHEN page_id < top OR page_id IS NULL AND top IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < top OR page_id IS NULL AND top IS NOT NULL THEN top END AS refers_to
FROM p JOIN t USING (h, n)
"""

OP12 = r"""
WITH e AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS s
      FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5),
n AS (SELECT p.a, p.b AS pos, p.s AS ps, s.b AS neg, s.s AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.s DESC, s.b) AS r
      FROM p JOIN s ON p.a = s.a AND NOT s.same AND 50 * p.s <= 100 * s.s AND 100 * s.s <= 95 * p.s)
SELECT a AS anchor_id, pos AS positive_id, CAST(r AS INT) AS rank, neg AS negative_id, ps AS positive_score, ns AS negative_score FROM n WHERE r <= 3
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode(CAST({0} AS VARCHAR))) || ':' || {0} END"
_CRC = ("xor(list_reduce(list_transform(range(strlen(s)), lambda i: CAST(ascii(s[i + 1]) AS BIGINT)), lambda c, x: "
        "list_reduce(range(8), lambda y, k: xor(y >> 1, 3988292384 * (y & 1)), xor(c, x)), 4294967295), 4294967295)")


def _fold(levels: int, name: str) -> str:
    """Levels of a forest ``name``0 (t, n, i, h, ...) as CTEs: digests, and the
    texts left and right of a node among its parent's children."""
    out = []
    for k in range(levels):
        out.append(f"""{name}{k}s AS (SELECT t, n, i, h,
  coalesce(string_agg(h, '' ORDER BY i) OVER (PARTITION BY t, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '' ORDER BY i) OVER (PARTITION BY t, i // 16 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k}),
{name}{k + 1} AS (SELECT t, CAST(ceil(n / 16.0) AS BIGINT) AS n, i // 16 AS i, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
  FROM {name}{k} GROUP BY t, n, i // 16)""")
    return ",\n".join(out)


def _climb(levels: int, name: str, start: str, cols: str) -> str:
    """CTEs that carry ``start`` (t, p, proof, f, cols) up to its root."""
    out, at = [], start
    for k in range(levels):
        out.append(f"""{start}_{k} AS (SELECT c.t, c.p // 16 AS p, c.proof || l || r AS proof,
  CASE WHEN s.n = 1 THEN c.f ELSE sha256(l || c.f || r) END AS f, {cols} FROM {at} c JOIN {name}{k}s s ON s.t = c.t AND s.i = c.p)""")
        at = f"{start}_{k}"
    return ",\n".join(out)


def _op13(levels: int = 5, tops: int = 3) -> str:
    fields = [_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = f"CASE WHEN {_CRC} % 5 = 0 THEN translate(text, '{upper}', '{upper.lower()}') ELSE text END"
    return f"""
WITH d AS (SELECT *, CAST(doc_id AS VARCHAR) AS s FROM documents),
x AS (SELECT * EXCLUDE (text), text, {low} AS now FROM d),
leaf AS (SELECT doc_id, coalesce('=' || source, '-') AS t, sha256({' || '.join(fields)}) AS h,
         sha256({' || '.join(fields[:-1])} || {_FIELD.format('now')}) AS f FROM x),
ranked AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY t) AS n FROM leaf),
a0 AS (SELECT t, n, i, h FROM ranked),
{_fold(levels, 'a')},
b0 AS (SELECT '' AS t, count(*) OVER () AS n, row_number() OVER (ORDER BY encode(t)) - 1 AS i, h, t AS of FROM a{levels}),
{_fold(tops, 'b')},
q AS (SELECT t, i AS p, '' AS proof, f, doc_id, h AS leaf FROM ranked),
{_climb(levels, 'a', 'q', 'doc_id, leaf')},
z AS (SELECT '' AS t, b0.i AS p, proof, f, doc_id, leaf, b0.h AS subroot FROM q_{levels - 1} c JOIN b0 ON b0.of = c.t),
{_climb(tops, 'b', 'z', 'doc_id, leaf, subroot')}
SELECT doc_id, leaf, subroot, b{tops}.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = b{tops}.h AS verified
FROM z_{tops - 1} CROSS JOIN b{tops}
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_decontaminate": OP3, "op5_line_dedup": OP5, "op7_backoff_lm": OP7, "op8_jaccard_join": OP8, "op10_suffix_dedup": OP10,
            "op11_warc": OP11, "op12_hard_negatives": OP12, "op13_merkle": _op13()}
