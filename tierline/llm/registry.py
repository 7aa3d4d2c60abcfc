"""The operators' queries by name, and the SQL that states their results where SQL can."""

from tierline.llm import (
    centroids, decontaminate, embeddings, html_text, lexical, minhash, mixing, quality, secrets, sharding, tokens,
    toxicity, warc,
)

QUERIES = {
    f.__name__: f
    for f in (
        html_text.op1_main_text,
        toxicity.op2_toxicity_knn,
        sharding.op3_shard_hypergeometric,
        tokens.op4_token_counts,
        warc.op5_warc_boundary_chain,
        embeddings.op6_near_vectors_nn_descent,
        decontaminate.op7_decontaminate_spaced_seeds,
        secrets.op8_secret_trigrams,
        minhash.op9_near_dup_tensored,
        mixing.op10_mix_entropy,
        centroids.op11_dimension_sharded_lloyd,
        lexical.op12_search_nra,
        quality.op13_quality_boosted_trees,
    )
}

ASSIGN = secrets.RULES[0].pattern.replace("'", "''")

# Smallest id reachable over ``links`` (a, b, both ways) for all ``nodes`` (id).
_REACH = """
reach(id, root) AS (SELECT id, id FROM nodes UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.id),
roots AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)"""



def _lloyd_sql(rounds: int) -> str:
    """Assignments a<i> by centroids c<i>, one pair of steps per round; equally near centroids by number."""
    near = """a{i} AS (SELECT vec_id, (min(d * 8 + cluster) % 8)::INT AS cluster, (min(d * 8 + cluster) // 8)::BIGINT AS distance
  FROM (SELECT vec_id, cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS d FROM v JOIN c{i} c USING (j)
        GROUP BY vec_id, cluster) GROUP BY vec_id)"""
    move = """m{i} AS (SELECT cluster, j, sum(x)::BIGINT AS s, count(*) AS n FROM v JOIN a{i} USING (vec_id) GROUP BY cluster, j),
c{n} AS (SELECT cluster, j, CASE WHEN n IS NULL THEN x ELSE ((s - ((s % n) + n) % n) // n)::BIGINT END AS x
  FROM c{i} LEFT JOIN m{i} USING (cluster, j))"""
    steps = [near.format(i=0)]
    for i in range(rounds):
        steps += [move.format(i=i, n=i + 1), near.format(i=i + 1)]
    return f"""
WITH kept AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = 64
              AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
v AS (SELECT vec_id, unnest(range(64)) AS j, unnest(list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT)) AS x
      FROM kept),
first AS (SELECT vec_id, (row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1)::INT AS cluster FROM kept
          QUALIFY cluster < 8),
c0 AS (SELECT cluster, j, x FROM first JOIN v USING (vec_id)),
{", ".join(steps)},
digests AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN digests USING (cluster)"""


ORACLES = {
    "op12_search_nra": r"""
WITH d AS (SELECT doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents WHERE text IS NOT NULL),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE text IS NOT NULL),
total AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS words FROM d WHERE len(terms) > 0),
m AS (SELECT id, 100 - 75 + (75 * len(terms) * docs) // words AS m FROM d, total WHERE len(terms) > 0),
tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, docs),
i AS (SELECT id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS impact FROM tf JOIN w USING (term) JOIN m USING (id)),
s AS (SELECT item_id, id, sum(impact)::BIGINT AS score FROM q JOIN i USING (term) GROUP BY ALL)
SELECT item_id, rank::INT AS rank, id AS doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, id) AS rank FROM s WHERE score > 0)
WHERE rank <= 10""",
    "op11_dimension_sharded_lloyd": _lloyd_sql(centroids.ROUNDS),
    "op5_warc_boundary_chain": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
     d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM p),
     b AS (SELECT page_id, payload_bytes, hex, list_transform(range(32), lambda i:
              ('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4)) & 31) AS digits FROM d),
     f AS (SELECT *, array_to_string(list_transform(digits, lambda x:
              substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x + 1)::INT, 1)), '') AS payload_digest,
              min(page_id) OVER (PARTITION BY hex) AS first_id FROM b)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f""",
    "op6_near_vectors_nn_descent": f"""
WITH RECURSIVE v AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS e FROM embeddings
                     WHERE label IS NOT NULL AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
links AS (SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.label = y.label AND x.id <> y.id
          WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
nodes AS (SELECT vec_id AS id FROM embeddings), {_REACH}
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = r.id) AS n_links, component_id, id = component_id AS kept
FROM roots r""",
    "op8_secret_trigrams": f"""
WITH kinds AS (
  SELECT * FROM (VALUES (0, 'assign', '{ASSIGN}', 2, 8), (1, 'access', 'AKIA[A-Z0-9]+', 0, 16),
                        (2, 'hex', '[0-9a-f]+', 0, 32)) k(kind, name, pattern, part, least)),
pieces AS (
  SELECT doc_id, 0 AS kind, string_split_regex(text, '{ASSIGN}') AS gaps, regexp_extract_all(text, '{ASSIGN}') AS hits,
         regexp_extract_all(text, '{ASSIGN}', 2) AS parts FROM documents UNION ALL
  SELECT doc_id, 1, string_split_regex(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+'),
         regexp_extract_all(text, 'AKIA[A-Z0-9]+') FROM documents UNION ALL
  SELECT doc_id, 2, string_split_regex(text, '[0-9a-f]+'), regexp_extract_all(text, '[0-9a-f]+'),
         regexp_extract_all(text, '[0-9a-f]+') FROM documents),
flat AS (SELECT doc_id, kind, unnest(range(len(hits))) AS i, unnest(gaps[:len(hits)]) AS gap, unnest(hits) AS hit,
                unnest(parts) AS part FROM pieces),
ends AS (SELECT *, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS stop
         FROM flat),
spans AS (SELECT doc_id, e.kind, stop - length(hit) AS start,
                 concat_ws(':', name, stop - length(hit), stop) AS span
          FROM ends e JOIN kinds k ON e.kind = k.kind WHERE length(e.part) >= least),
found AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
                 count(*) FILTER (kind = 2) AS n_hex, string_agg(span, ',' ORDER BY start, kind) AS spans
          FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN found USING (doc_id)""",
    "op9_near_dup_tensored": f"""
WITH RECURSIVE w AS (
  SELECT doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [words]
        ELSE list_transform(range(1, len(words) - 2), lambda i: words[i:i + 3]) END) AS shingle FROM w),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
met AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM s x JOIN s y ON x.shingle = y.shingle AND x.id < y.id
         GROUP BY ALL),
one AS (SELECT a, b FROM met JOIN n p ON p.id = a JOIN n q ON q.id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
links AS (SELECT a, b FROM one UNION ALL SELECT b, a FROM one),
nodes AS (SELECT doc_id AS id FROM documents), {_REACH}
SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, id = component_id AS kept
FROM roots LEFT JOIN n USING (id)""",
}
