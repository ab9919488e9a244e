"""SQL equivalents, for DuckDB, of the queries that SQL can express over whole tables."""

from __future__ import annotations

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"



def _vector_codes() -> str:
    """Six rounds of assignment and update, written one after another."""
    nearest = """n{k} AS MATERIALIZED (SELECT rid, part, min(d * 16 + e) AS m FROM (SELECT p.rid, p.part, c.e, list_sum([(p.x[i] - c.y[i]) * (p.x[i] - c.y[i]) for i in range(1, len(p.x) + 1)]) AS d FROM p JOIN c{k} c ON c.part = p.part) GROUP BY 1, 2)"""
    means = """c{j} AS MATERIALIZED (SELECT c.part, c.e, coalesce(y2, y) AS y FROM c{k} c LEFT JOIN (SELECT part, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS y2 FROM (SELECT part, e, i, sum(x) AS s, count(*) AS n FROM (SELECT p.part, CAST(n.m % 16 AS BIGINT) AS e, unnest(range(1, len(p.x) + 1)) AS i, unnest(p.x) AS x FROM p JOIN n{k} n ON n.rid = p.rid AND n.part = p.part) GROUP BY 1, 2, 3) GROUP BY 1, 2) u ON u.part = c.part AND u.e = c.e)"""
    rounds = ",\n".join(f"{nearest.format(k=k)},\n{means.format(k=k, j=k + 1)}" for k in range(6))
    return f"""WITH v AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) AS rid, [CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT) for x in embedding] AS v FROM embeddings WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
p AS MATERIALIZED (SELECT rid, part, v[part * len(v) // 8 + 1:(part + 1) * len(v) // 8] AS x FROM (SELECT rid, v, unnest(range(8)) AS part FROM v)),
c0 AS (SELECT part, rid - 1 AS e, x AS y FROM p WHERE rid <= 16),
{rounds},
{nearest.format(k=6)},
r AS (SELECT rid, string_agg(printf('%02x', CAST(m % 16 AS BIGINT)), '' ORDER BY part) AS code, CAST(sum(m // 16) AS BIGINT) AS error FROM n6 GROUP BY 1),
b AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, e)) AS s FROM c6)
SELECT v.vec_id, r.code, r.error, CAST(sum(r.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error, b.s AS codebooks_sha256 FROM v JOIN r ON r.rid = v.rid, b"""


ORACLE_SQL = {
    "op1_ngram_jaccard_join": f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_FOLD.format("coalesce(text, '')"))} AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
l AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM l JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.c AS component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS c FROM r GROUP BY 1) c ON c.a = d.doc_id""",
    "op3_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h) ELSE page_id END AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to FROM f""",
    "op6_substring_dedup": f"""WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13)),
m AS (SELECT *, min(doc_id) OVER (PARTITION BY s) AS least FROM s),
d AS (SELECT DISTINCT doc_id, i + k AS i FROM (SELECT doc_id, i, unnest(range(0, 13)) AS k FROM m WHERE least < doc_id)),
x AS (SELECT doc_id, i, w[i] AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
k AS (SELECT x.doc_id, string_agg(t, ' ' ORDER BY x.i) AS t, count(*) AS n FROM x LEFT JOIN d ON x.doc_id = d.doc_id AND x.i = d.i WHERE d.i IS NULL GROUP BY 1)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256 FROM w LEFT JOIN k ON w.doc_id = k.doc_id""",
    "op7_benchmark_decontamination": f"""WITH w AS (SELECT doc_id, {_ALNUM.format(_FOLD.format("coalesce(text, '')"))} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM.format(_FOLD.format("coalesce(text, '')"))} AS w FROM benchmark),
p AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS s FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
z AS (SELECT DISTINCT n FROM p),
s AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM w, z WHERE len(w) >= n)),
h AS (SELECT s.doc_id, s.i, s.n, p.item FROM s JOIN p ON s.n = p.n AND s.s = p.s),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(0, n)) AS k FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY 1)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n, 0) AS BIGINT) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM w LEFT JOIN c ON w.doc_id = c.doc_id LEFT JOIN t ON w.doc_id = t.doc_id""",
    "op9_suffix_array_dedup": """WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
s AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 199)) AS i FROM t WHERE n >= 200)),
r AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM (SELECT *, count(*) OVER (PARTITION BY s) AS c FROM s) WHERE c > 1),
g AS (SELECT *, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM r),
p AS (SELECT doc_id, k, min(i) AS a, max(i) + 200 AS b FROM g GROUP BY 1, 2),
q AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS z FROM p),
o AS (SELECT q.doc_id, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept, count(*) AS spans, sum(b - a) AS gone FROM q JOIN t ON q.doc_id = t.doc_id GROUP BY 1)
SELECT t.doc_id, CAST(t.n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM t LEFT JOIN o ON t.doc_id = o.doc_id""",
    "op11_conversation_repair": r"""WITH RECURSIVE z AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS b FROM conversations),
d AS (SELECT k.*, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS f FROM k, z),
a AS (SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE f WHEN 3 THEN [0, 1] ELSE [0] END) AS again FROM d WHERE f <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM a),
r AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 2 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 3 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 1 ELSE 0 END AS code, left(role, 1) AS c FROM o),
e AS (SELECT conv_id, i, code, CASE WHEN code = 1 THEN 3 ELSE 0 END AS x, c, role, text FROM r),
n AS (SELECT DISTINCT conv_id, n FROM r),
b AS (SELECT conv_id, n + 1 AS i, [0, 6, 3, 0] AS v FROM n UNION ALL
 SELECT conv_id, i, [least(w[1], 3 + least(w[3], 3 + w[4])), least(w[2], 3 + least(w[3], 3 + w[4])), least(w[3], 3 + w[4]), least(w[4], 3 + w[3])] FROM (
  SELECT b.conv_id, e.i, CASE WHEN e.code >= 2 THEN [4 + v[1], 4 + v[2], 4 + v[3], 4 + v[4]] ELSE [
   least(4 + v[1], 3 + x + v[3], CASE e.c WHEN 's' THEN x + v[2] WHEN 'u' THEN x + v[3] ELSE 1000000 END), least(4 + v[2], 3 + x + v[3], CASE e.c WHEN 'u' THEN x + v[3] ELSE 1000000 END),
   least(4 + v[3], 3 + x + v[4], CASE e.c WHEN 'a' THEN x + v[4] ELSE 1000000 END), least(4 + v[4], 3 + x + v[3], CASE e.c WHEN 'u' THEN x + v[3] ELSE 1000000 END)] END AS w
  FROM b JOIN e ON b.conv_id IS NOT DISTINCT FROM e.conv_id AND e.i = b.i - 1)),
f AS (SELECT conv_id, CAST(1 AS BIGINT) AS i, 1 AS s, '' AS audit, CAST([] AS VARCHAR[]) AS kept FROM n UNION ALL
 SELECT conv_id, CASE l WHEN 'I' THEN i ELSE i + 1 END, CASE l WHEN 'D' THEN s WHEN 'K' THEN nx ELSE g END, audit || l,
  CASE l WHEN 'D' THEN kept WHEN 'K' THEN list_append(kept, role || ':' || text) ELSE list_append(kept, CASE g WHEN 3 THEN 'user:' ELSE 'assistant:' END || CASE l WHEN 'R' THEN text ELSE '' END) END FROM (
  SELECT *, CASE WHEN 4 + y[s] = v[s] THEN 'D' WHEN 3 + v[g] = v[s] THEN 'I' WHEN code < 2 AND x + y[nx] = v[s] THEN 'K' ELSE 'R' END AS l FROM (
   SELECT f.*, p.v, q.v AS y, e.code, e.x, e.role, e.text, CASE f.s WHEN 3 THEN 4 ELSE 3 END AS g, CASE WHEN f.s = 1 AND e.c = 's' THEN 2 WHEN f.s <> 3 AND e.c = 'u' THEN 3 WHEN f.s = 3 AND e.c = 'a' THEN 4 END AS nx
   FROM f JOIN b p ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND p.i = f.i LEFT JOIN b q ON q.conv_id IS NOT DISTINCT FROM f.conv_id AND q.i = f.i + 1 LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM f.conv_id AND e.i = f.i)
  WHERE y IS NOT NULL OR s IN (2, 3))),
m AS (SELECT f.conv_id, f.audit, f.kept FROM f JOIN n ON f.conv_id IS NOT DISTINCT FROM n.conv_id AND f.i = n.n + 1 AND f.s IN (1, 4)),
u AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (code = 2) AS blank, count(*) FILTER (code = 3) AS duplicate, count(*) FILTER (code = 1) AS truncated, count(*) FILTER (p || c NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT *, lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS p FROM r) GROUP BY 1)
SELECT h.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(w.v[1], 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(kept, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) h LEFT JOIN u ON u.conv_id IS NOT DISTINCT FROM h.conv_id LEFT JOIN m ON m.conv_id IS NOT DISTINCT FROM h.conv_id LEFT JOIN b w ON w.conv_id IS NOT DISTINCT FROM h.conv_id AND w.i = 1""",
    "op12_vector_codes": _vector_codes(),
}
