"""DuckDB SQL for the queries that SQL can state: the definitions, without the operators' methods."""

_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"

# A window is the list of its words; the smallest id of each is compared with the row's own.
_OP2 = f"""
WITH w AS (SELECT doc_id, {_WORDS.format('text')} AS words FROM documents),
win AS (SELECT doc_id, words, s, words[s:s + 12] AS win
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS s FROM w WHERE len(words) >= 13)),
least AS (SELECT win, min(doc_id) AS first FROM win GROUP BY win),
hit AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM win JOIN least USING (win) WHERE first < doc_id),
gone AS (SELECT doc_id, list(p) AS ps FROM hit GROUP BY doc_id),
kept AS (SELECT w.doc_id, words, coalesce(ps, []) AS ps FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, len(words)::BIGINT AS n_words, len(ps)::BIGINT AS n_removed,
  sha256(array_to_string(list_filter(words, lambda x, i: NOT list_contains(ps, i)), ' ')) AS kept_sha256
FROM kept
"""

_FOLDED = (r"regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
           r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

_OP3 = f"""
WITH items AS (SELECT DISTINCT item_id::VARCHAR AS item, {_FOLDED.format('text')} AS words FROM benchmark WHERE item_id IS NOT NULL),
pats AS (SELECT DISTINCT item, words[s:s + least(len(words), 10) - 1] AS win
         FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 8, 2))) AS s FROM items WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM pats),
docs AS (SELECT doc_id, {_FOLDED.format('text')} AS words FROM documents),
wins AS (SELECT doc_id, s, words[s:s + n - 1] AS win
         FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM docs, sizes WHERE len(words) >= n)),
hits AS (SELECT doc_id, s, win, item FROM wins JOIN pats USING (win)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + len(win))) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_OP5 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

# Cosines of all pairs of a label, and the smallest id over the links.
_OP9 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
many AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON vec_id = least.a LEFT JOIN many ON vec_id = many.a
"""

# Shingle sets meet in an inverted list; shared counts give the Jaccard similarity.
_OP10 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format('text')} AS words FROM documents),
sh AS (SELECT DISTINCT doc_id, words[s:s + 4] AS g
       FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS s FROM w WHERE len(words) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
pairs AS (SELECT a, b FROM common JOIN size x ON a = x.doc_id JOIN size y ON b = y.doc_id WHERE common.n * 5 >= (x.n + y.n - common.n) * 4),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a),
least AS (SELECT a, min(b) AS class_id FROM reach GROUP BY a),
many AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_links, class_id, doc_id = class_id AS kept
FROM documents JOIN least ON doc_id = least.a LEFT JOIN many ON doc_id = many.a
"""

_WHOLE = "list_transform(embedding, lambda x: floor(256 * x::DOUBLE))"
_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

# Every anchor against every row; doubles hold these integers exactly.
_OP12 = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_WHOLE} AS e
  FROM embeddings WHERE label IS NOT NULL AND {_FINITE}),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


def _lloyd(rounds: int) -> str:
    """Every distance of every round; doubles hold these integers exactly."""
    parts = [f"""v AS MATERIALIZED (SELECT vec_id, {_WHOLE} AS e FROM embeddings WHERE len(embedding) = 64 AND {_FINITE})""",
             """c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1)::INTEGER AS cluster, e FROM v
  QUALIFY cluster < 40)"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, v.e AS e, cluster,
  (list_dot_product(v.e, v.e) + list_dot_product(c.e, c.e) - 2 * list_dot_product(v.e, c.e))::BIGINT AS distance
  FROM v CROSS JOIN c{r} c QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)""")
        if r < rounds:
            parts.append(f"""m{r} AS (SELECT cluster, i, floor(sum(e[i]) / count(*)) AS x
  FROM (SELECT cluster, e, unnest(range(1, 65)) AS i FROM a{r}) GROUP BY cluster, i)""")
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT cluster, coalesce(n.e, c.e) AS e FROM c{r} c
  LEFT JOIN (SELECT cluster, list(x ORDER BY i) AS e FROM m{r} GROUP BY cluster) n USING (cluster))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(list_transform(c.e, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c USING (cluster)
"""


SQL = {"op2_substring_dedup": _OP2, "op3_decontamination": _OP3, "op5_warc": _OP5, "op9_embedding_forest": _OP9, "op10_ngram_join": _OP10,
       "op12_kronecker_negatives": _OP12, "op13_ns_kmeans": _lloyd(5)}
