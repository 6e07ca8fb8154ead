"""SQL that an independent engine runs over the same tables."""

from tripfold.llm import clustering, divergence

DIVERGENCE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
t AS (SELECT r, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term
         HAVING count(DISTINCT r) >= {divergence.MIN_DOCS}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term)
      GROUP BY t.lang, t.source, t.term),
dense AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0)::HUGEINT AS n, v.v::HUGEINT AS v
  FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
of_group AS (
  SELECT *, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source)::HUGEINT
         + 2 * v) AS p
  FROM dense),
of_lang AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) //
         (sum(n) OVER (PARTITION BY lang)::HUGEINT + 2 * v) AS q
  FROM (SELECT lang, term, v, sum(n)::HUGEINT AS n FROM dense GROUP BY lang, term, v)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS f
  FROM of_group a JOIN of_group b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item,
         (((p - q) * (p - q)) // (p + q))::BIGINT AS value
  FROM of_group JOIN of_lang USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= {divergence.TOP}
"""


def lloyd(
    clusters: int = clustering.CLUSTERS,
    rounds: int = clustering.ROUNDS,
    width: int = clustering.DIMENSIONS,
) -> str:
    """Every round is one statement: distances, the nearest centroid, floored means."""
    parts = [
        f"""
k AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, x FROM (
    SELECT vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE len(embedding) = {width}
      AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {width})),
v AS MATERIALIZED (SELECT r, unnest(x) AS x, unnest(range({width})) AS i FROM k),
c0 AS MATERIALIZED (
  SELECT c, unnest(x) AS x, unnest(range({width})) AS i FROM (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS c, x FROM k
    ORDER BY sha256('3:' || vec_id), x LIMIT {clusters}))"""
    ]
    for k in range(rounds + 1):
        parts.append(
            f"""
a{k} AS MATERIALIZED (
  SELECT r, min(c) AS c, min(d) AS d FROM (
    SELECT r, c, d, min(d) OVER (PARTITION BY r) AS least FROM (
      SELECT r, c, sum((v.x - m.x) * (v.x - m.x)) AS d FROM v JOIN c{k} m USING (i) GROUP BY r, c))
  WHERE d = least GROUP BY r)"""
        )
        if k < rounds:
            parts.append(
                f"""
c{k + 1} AS MATERIALIZED (
  SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, m.x)::BIGINT AS x
  FROM c{k} m LEFT JOIN (
    SELECT c, i, sum(v.x) AS s, count(*)::HUGEINT AS n FROM v JOIN a{k} USING (r) GROUP BY c, i)
  USING (c, i))"""
            )
    return (
        f"WITH {','.join(parts)},\n"
        "h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS h"
        f" FROM c{rounds} GROUP BY c)\n"
        "SELECT vec_id, c::INT AS cluster, d::BIGINT AS distance,\n"
        "  (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,\n"
        "  (sum(d) OVER ())::BIGINT AS inertia, h AS centroid_sha256\n"
        f"FROM a{rounds} JOIN k USING (r) JOIN h USING (c)"
    )


#: Vectors that take part, one a vec_id, in double precision.
VECTORS = """
v AS MATERIALIZED (
  SELECT vec_id, list_transform(min(embedding), lambda e: e::DOUBLE) AS x FROM embeddings
  WHERE len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = len(embedding)
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0
  GROUP BY vec_id)"""

#: The least identifier that links ``e`` (both directions) lead to from each of ``every``.
REACHED = """
reached AS (
  SELECT id, id AS other FROM every
  UNION
  SELECT reached.id, e.b FROM reached JOIN e ON e.a = reached.other),
component AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)"""

EMBEDDING_LINKS = f"""
WITH RECURSIVE {VECTORS},
e AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95),
every AS (SELECT DISTINCT vec_id AS id FROM embeddings),
{REACHED}
SELECT r.vec_id, (SELECT count(*) FROM e WHERE e.a = r.vec_id)::BIGINT AS n_links,
  component_id, component_id = r.vec_id AS kept
FROM (SELECT vec_id FROM embeddings) r JOIN component ON component.id = r.vec_id
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) = 0 THEN []::VARCHAR[]
         WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    END) AS shingle
  FROM d),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS MATERIALIZED (
  SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
every AS (SELECT DISTINCT doc_id AS id FROM documents),
{REACHED}
SELECT r.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id,
  component_id = r.doc_id AS kept
FROM (SELECT doc_id FROM documents) r JOIN component ON component.id = r.doc_id
LEFT JOIN n ON n.doc_id = r.doc_id
"""

NEAREST = f"""
WITH {VECTORS},
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_reduce(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]), lambda a, b: a + b)
      AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored)
WHERE rank <= 20
"""

SQL = {
    "op1_embedding_near_dedup": EMBEDDING_LINKS,
    "op4_minhash_near_dedup": NEAR_DUPLICATES,
    "op8_nearest": NEAREST,
    "op12_centroid_clustering": lloyd(),
    "op13_source_divergence": DIVERGENCE,
}
