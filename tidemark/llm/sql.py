"""SQL of queries that is made from rules: CRC-32 byte by byte, and rounds of clustering one after another."""

from __future__ import annotations

RESAMPLING = r"""
WITH crc AS (  -- the table of CRC-32, from its polynomial
    SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
    FROM range(256) t(i)
), texts AS (
    SELECT true AS ours, doc_id AS id, coalesce(text, '') AS text FROM documents UNION ALL SELECT false, item_id, coalesce(text, '') FROM benchmark
), words AS (
    SELECT ours, id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts
), hashed AS (
    SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)
), bytes AS (
    SELECT word, list_transform(range(1, len(h) // 2 + 1),
        lambda k: (strpos('0123456789ABCDEF', h[2 * k - 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2 * k]) - 1) AS b FROM hashed
), buckets AS (
    SELECT word, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(tab[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
    FROM bytes, crc
), held AS (
    SELECT bucket, count(*) FILTER (ours) AS s, count(*) FILTER (NOT ours) AS t FROM words JOIN buckets USING (word) GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM held
), weights AS (
    SELECT id, count(*) AS n, sum(gain)::BIGINT AS weight FROM words JOIN buckets USING (word) JOIN gains USING (bucket) WHERE ours GROUP BY id
), scores AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM documents LEFT JOIN weights ON doc_id = id
), ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS able FROM scores WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * able // 100 THEN rank END AS rank FROM scores LEFT JOIN ranked USING (doc_id)
"""


def clustering(k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """One row per vector as ``cluster_report`` gives it; every round is a pair of table expressions."""

    def assigned(turn: int) -> str:
        return f"""
a{turn} AS MATERIALIZED (
    SELECT row, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (
        SELECT row, cluster, sum((x - c) * (x - c))::BIGINT AS d FROM numbers JOIN c{turn} USING (place) GROUP BY row, cluster
    ) GROUP BY row
)"""

    def moved(turn: int) -> str:
        total, many = "sum(x)::HUGEINT", "count(*)"
        return f"""
c{turn} AS MATERIALIZED (
    SELECT place, cluster, coalesce(mean, c) AS c FROM c{turn - 1} LEFT JOIN (
        SELECT cluster, place, (({total} - ((({total} % {many}) + {many}) % {many})) // {many})::BIGINT AS mean
        FROM a{turn - 1} JOIN numbers USING (row) GROUP BY cluster, place
    ) USING (cluster, place)
)"""

    steps = [part for turn in range(1, rounds + 1) for part in (moved(turn), assigned(turn))]
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), numbers AS MATERIALIZED (
    SELECT row, unnest(range({size})) AS place, unnest(v) AS x FROM kept
), c0 AS MATERIALIZED (
    SELECT unnest(range({size})) AS place, (row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1)::INT AS cluster, unnest(v) AS c
    FROM (SELECT * FROM kept ORDER BY sha256('{seed}:' || vec_id), v LIMIT {k})
),{assigned(0)},{",".join(steps)}, digests AS (
    SELECT cluster, sha256(string_agg(c::VARCHAR, ',' ORDER BY place)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster
)
SELECT vec_id, cluster, d AS distance, (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (row) JOIN digests USING (cluster)
"""
