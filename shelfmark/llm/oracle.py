"""DuckDB SQL for the registered queries that SQL can express, by brute force over whole tables."""

from .license_scan import TEMPLATES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


_TEMPLATES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())
_ALNUM = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"


def _grams(name: str, source: str, key: str, words: str, k: int) -> str:
    """CTE of the distinct k-word shingles of a table."""
    return f"""{name} AS (SELECT DISTINCT {key}, array_to_string(ws[s:s + {k - 1}], ' ') AS g
      FROM (SELECT {key}, {words} AS ws FROM {source}), unnest(range(1, len(ws) - {k - 2})) AS t(s))"""


def _round(n: int) -> str:
    """CTEs of one round of op11: each vector's nearest centroid of c<n> as a<n>, and the moved centroids c<n + 1>."""
    return f"""a{n} AS (SELECT vec_id, v, arg_min(i, (d, i)) AS i, min(d) AS d FROM (SELECT q.vec_id, q.v, c.i,
        list_sum(list_transform(list_zip(q.v, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM q, c{n} c) GROUP BY vec_id, v),
m{n} AS (SELECT i, list(m ORDER BY j) AS c FROM (SELECT i, j, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS m
        FROM (SELECT i, unnest(v) AS x, unnest(range(1, 65)) AS j FROM a{n}) GROUP BY i, j) GROUP BY i),
c{n + 1} AS (SELECT c{n}.i, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} USING (i))"""


ORACLE = {
    "op2_line_dedup": r"""
WITH l AS (SELECT doc_id, i, ls[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), unnest(range(1, len(ls) + 1)) AS t(i)),
k AS (SELECT doc_id, line, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
w AS (SELECT a.doc_id, a.k, a.i AS i0, b.i AS i1, a.line || chr(10) || b.line AS body FROM k a JOIN k b ON b.doc_id = a.doc_id AND b.k = a.k + 1),
h AS (SELECT *, first_value(doc_id) OVER f AS head_doc, first_value(k) OVER f AS head_k, row_number() OVER f AS n
      FROM w WINDOW f AS (PARTITION BY body ORDER BY doc_id, k)),
gone AS (SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = head_doc AND k - head_k = 1 THEN i1 ELSE i0 END, i1 + 1)) AS i FROM h WHERE n > 1)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(x.body, '') END AS text, coalesce(x.removed, 0)::INT AS lines_removed
FROM documents d LEFT JOIN (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL) AS body, count(g.i) AS removed
                            FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id) x USING (doc_id)""",
    "op3_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS last,
        array_to_string(list_transform(string_split(hex, ''), lambda c: ['0000','0001','0010','0011','0100','0101','0110','0111',
          '1000','1001','1010','1011','1100','1101','1110','1111'][strpos('0123456789abcdef', c)]), '') AS bits FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + 16 * substr(bits, 1 + 5 * i, 1)::INT + 8 * substr(bits, 2 + 5 * i, 1)::INT + 4 * substr(bits, 3 + 5 * i, 1)::INT
       + 2 * substr(bits, 4 + 5 * i, 1)::INT + substr(bits, 5 + 5 * i, 1)::INT)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM q""",
    "op5_minhash_near_dedup": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_words(_LOWER)} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g FROM w, unnest(range(1, greatest(len(ws) - 1, least(len(ws), 1) + 1))) AS t(i)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
e AS (SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
      GROUP BY 1, 2, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
r(u, v) AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(m.low, d.doc_id)) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT u AS doc_id, min(v) AS low FROM r GROUP BY 1) m USING (doc_id)""",
    "op6_embedding_near_dedup": """
WITH RECURSIVE g AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
                     WHERE list_aggregate(list_transform(embedding, lambda x: (x IS NOT NULL AND isfinite(x))::INT), 'min') = 1
                       AND list_aggregate(list_transform(embedding, lambda x: abs(x)), 'max') > 0),
e AS (SELECT a.vec_id AS u, b.vec_id AS v FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
r(u, v) AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u)
SELECT x.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, least(x.vec_id, coalesce(m.low, x.vec_id)) AS component_id,
       x.vec_id = least(x.vec_id, coalesce(m.low, x.vec_id)) AS kept
FROM embeddings x LEFT JOIN (SELECT u AS vec_id, count(*) AS n FROM e GROUP BY 1) c USING (vec_id)
LEFT JOIN (SELECT u AS vec_id, min(v) AS low FROM r GROUP BY 1) m USING (vec_id)""",
    "op7_license_scan": f"""
WITH {_grams('d', 'documents', 'doc_id', _ALNUM, 5)},
{_grams('t', f'(VALUES {_TEMPLATES}) AS v(license_id, text)', 'license_id', _ALNUM, 5)},
n AS (SELECT license_id, count(*) AS n FROM t GROUP BY 1)
SELECT doc_id, license_id, n.n::INT AS n_shingles, count(*)::INT AS n_found
FROM d JOIN t USING (g) JOIN n USING (license_id) GROUP BY doc_id, license_id, n.n HAVING 100 * count(*) >= 80 * n.n""",
    "op9_substring_dedup": f"""
WITH w AS (SELECT doc_id, {_words("coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT doc_id, s, md5(array_to_string(ws[s:s + 49], ' ')) AS h FROM w, unnest(range(1, len(ws) - 48)) AS t(s)),
low AS (SELECT h, min(doc_id) AS lo FROM win GROUP BY h),
gone AS (SELECT doc_id, list(DISTINCT s + o) AS pos FROM win JOIN low USING (h), unnest(range(0, 50)) AS u(o) WHERE doc_id > lo GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(pos), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN pos IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(pos, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)""",
    "op10_decontamination": f"""
WITH {_grams('d', 'documents', 'doc_id', _words(_LOWER), 5)},
{_grams('t', 'benchmark', 'item_id', _words(_LOWER), 5)},
n AS (SELECT item_id, count(*) AS n FROM t GROUP BY 1),
short AS (SELECT DISTINCT item_id, ' ' || array_to_string(ws, ' ') || ' ' AS s FROM (SELECT item_id, {_words(_LOWER)} AS ws FROM benchmark)
          WHERE len(ws) BETWEEN 1 AND 4),
spaced AS (SELECT doc_id, ' ' || array_to_string({_words(_LOWER)}, ' ') || ' ' AS s FROM documents)
SELECT doc_id, item_id, n.n::INT AS n_shingles, count(*)::INT AS n_found
FROM d JOIN t USING (g) JOIN n USING (item_id) GROUP BY doc_id, item_id, n.n HAVING 100 * count(*) >= 80 * n.n
UNION
SELECT doc_id, item_id, 1, 1 FROM spaced JOIN short ON contains(spaced.s, short.s)""",
    "op11_centroid_clustering": f"""
WITH q AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE len(embedding) = 64 AND list_aggregate(list_transform(embedding, lambda x: (x IS NOT NULL AND isfinite(x))::INT), 'min') = 1),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS i, v AS c FROM q QUALIFY i < 16),
{_round(0)},
{_round(1)},
{_round(2)},
{_round(3)}
SELECT vec_id, a3.i::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a3.i))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c3.c, ',')) AS centroid_sha256
FROM a3 JOIN c3 USING (i)""",
    "op12_hard_negatives": """
WITH q AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE label IS NOT NULL AND list_aggregate(list_transform(embedding, lambda x: (x IS NOT NULL AND isfinite(x))::INT), 'min') = 1),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
             list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM q a JOIN q b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other))::INT AS rank,
       s.other AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10""",
    "op13_url_filter": """
WITH r(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                                       ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (SELECT page_id, row_number() OVER () AS n, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, n, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT h.page_id, h.host, h.path, r.host || r.path AS rule, coalesce(r.verdict, 'allow') AS verdict
FROM h LEFT JOIN r ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path)
QUALIFY row_number() OVER (PARTITION BY h.n ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) = 1""",
}
