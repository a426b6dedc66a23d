"""DuckDB text of the queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op10_minhash_forest"] = r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[k:k+4], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM tokens WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id AS u, doc_id AS v FROM documents
  UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v
), least AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least ON least.u = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

ORACLE["op8_url_bloom_cascade"] = r"""
WITH parsed AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(kind, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), ruled AS (
  SELECT page_id, host, path, max_by(h || p, length(h || p)) AS rule, max_by(kind, length(h || p)) AS kind
  FROM parsed LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id, host, path
), listed AS (SELECT DISTINCT host AS l FROM ruled WHERE kind = 'block')
SELECT page_id, host, path, rule, coalesce(kind, CASE WHEN l IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled LEFT JOIN listed ON l = host
"""

ORACLE["op6_warc_archive"] = r"""
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
), coded AS (
  SELECT page_id, octet_length(encode(payload)) AS payload_bytes, max(page_id) OVER (PARTITION BY h) AS keep,
    array_to_string(list_transform(range(32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4)))::BIGINT & 31)::INT, 1)), '') AS payload_digest
  FROM hashed
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM coded
"""

ORACLE["op5_pivot_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score,
  row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id)::INT AS rank
FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
QUALIFY rank <= 5
"""


def _clusters(rounds: int, k: int) -> str:
    """Rounds of assignment and update one after the other; components and distances stay far below 2^53 here."""
    distance = "list_inner_product(v.e, v.e) - 2 * list_inner_product(v.e, c.e) + list_inner_product(c.e, c.e)"
    steps = ["""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""", f"""c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id), e) - 1)::INT AS c, e FROM v QUALIFY c < {k}
)"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT r, d // {k} AS d, (d % {k})::INT AS c FROM (SELECT v.r, min(({distance})::BIGINT * {k} + c.c) AS d FROM v CROSS JOIN c{i} c GROUP BY v.r)
)""")
        if i < rounds:
            steps.append(f"""s{i} AS MATERIALIZED (
  SELECT c, k, sum(e[k])::BIGINT AS s, count(*) AS n FROM a{i} JOIN v USING (r), range(1, 65) t(k) GROUP BY c, k
), c{i + 1} AS MATERIALIZED (
  SELECT c{i}.c, coalesce(m.e, c{i}.e) AS e FROM c{i} LEFT JOIN (SELECT c, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY k) AS e FROM s{i} GROUP BY c) m ON m.c = c{i}.c
)""")
    return "WITH " + ", ".join(steps) + f"""
SELECT vec_id, a.c AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(c.e, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (r) JOIN c{rounds} c ON c.c = a.c
"""


ORACLE["op12_va_file_clusters"] = _clusters(5, 40)

ORACLE["op13_multi_match_join"] = ORACLE["op10_minhash_forest"].replace("100 * count(*) >= 75 *", "100 * count(*) >= 80 *").replace(
    "coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept", "coalesce(n, 0) AS n_shingles, component_id")
