"""Queries of the training-data operators and their DuckDB SQL where SQL can express them."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickgate.llm import (ann, bpe, centroids, exact_dedup, line_dedup, merkle, mixing, near_dedup, pii, quality,
                          suffix_dedup, url_filter, warc)
from tickgate.llm.common import read


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(read(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    record_map = warc.write(read(spark, sf_dir, "pages"), warc.archive_folder(spark))
    r = warc.read_all(record_map, payloads=False)
    return r.select(F.col("record_id").try_cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                    F.col("refers_to").try_cast("long").alias("refers_to"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(read(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.group(read(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = mixing.plan(read(spark, sf_dir, "documents"))
    return p.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(read(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.prove(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_quality": op2_quality,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_warc": op5_warc,
    "op6_ann": op6_ann,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_pii": op8_pii,
    "op9_near_dedup": op9_near_dedup,
    "op10_mixing": op10_mixing,
    "op11_centroids": op11_centroids,
    "op12_line_dedup": op12_line_dedup,
    "op13_merkle": op13_merkle,
}



def _centroid_sql(k: int = 40, rounds: int = 5) -> str:
    """Each round: nearest centroid per vector, then the floor of the means."""
    steps = ""
    for r in range(rounds + 1):
        steps += f"""
a{r} AS MATERIALIZED (
  SELECT v.rid, min({{'d': list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'j': c.j}}) AS n
  FROM v, c{r} c GROUP BY v.rid),"""
        if r < rounds:
            steps += f"""
m{r} AS (
  SELECT j, list(CASE WHEN s % n < 0 THEN s // n - 1 ELSE s // n END ORDER BY i)::BIGINT[] AS q FROM (
    SELECT j, i, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM (
      SELECT a.n.j AS j, generate_subscripts(v.q, 1) AS i, unnest(v.q) AS x FROM a{r} a JOIN v USING (rid))
    GROUP BY j, i) GROUP BY j),
c{r + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.q, c.q) AS q FROM c{r} c LEFT JOIN m{r} m USING (j)),"""
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs(x) < 524288)) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, q) - 1 AS j, q FROM (
    SELECT q, sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h FROM v ORDER BY h, q LIMIT {k})),{steps}
t AS (SELECT n.j AS j, sum(n.d)::BIGINT AS s FROM a{rounds} GROUP BY n.j)
SELECT v.vec_id, a.n.j::INT AS cluster, a.n.d AS distance, t.s AS cluster_inertia,
       (SELECT sum(s)::BIGINT FROM t) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (rid) JOIN t ON t.j = a.n.j JOIN c{rounds} c ON c.j = a.n.j
"""


def _merkle_sql() -> str:
    """Trees grow level by level; leaves fold through the runs they stand in."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join([field(c) for c in ("doc_id", "source", "lang", "n_chars")] + [field(text)]) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = """xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda c, b:
      list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                  lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END), xor(c, b)), 4294967295), 4294967295)"""

    def grown(name: str, start: str) -> str:
        return f"""
{name}(tree, level, i, n, h) AS (
  SELECT tree, 0, i, n, h FROM {start}
  UNION ALL
  SELECT tree, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM {name}
  WHERE n > 1 GROUP BY tree, level, n, i // 8),
{name}_run AS (SELECT tree, level, i // 8 AS r, list(h ORDER BY i) AS hs FROM {name} WHERE n > 1 GROUP BY ALL)"""

    def folded(name: str, start: str, runs: str) -> str:
        return f"""
{name}(rid, tree, level, i, h, way) AS (
  SELECT rid, tree, 0, i, h, way FROM {start}
  UNION ALL
  SELECT f.rid, f.tree, f.level + 1, f.i // 8,
         sha256(array_to_string(list_transform(r.hs, lambda x, k: CASE WHEN k - 1 = f.i % 8 THEN f.h ELSE x END), '')),
         f.way || array_to_string(list_filter(r.hs, lambda x, k: k - 1 <> f.i % 8), '')
  FROM {name} f JOIN {runs} r ON r.tree = f.tree AND r.level = f.level AND r.r = f.i // 8),
{name}_end AS (SELECT rid, h, way FROM {name} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY level DESC) = 1)"""
    return f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS tree, {leaf("text")} AS h,
         CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} END AS other
  FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
             count(*) OVER (PARTITION BY tree) AS n FROM d),{grown("node", "l")},
s AS (SELECT 'root' AS tree, tree AS name, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, count(*) OVER () AS n
      FROM node WHERE n = 1),{grown("top", "s")},
low AS (SELECT rid, tree, i, coalesce(other, h) AS h, '' AS way FROM l),{folded("f", "low", "node_run")},
high AS (SELECT f.rid, 'root' AS tree, s.i, f.h, f.way FROM f_end f JOIN l USING (rid) JOIN s ON s.name = l.tree),{folded("g", "high", "top_run")}
SELECT l.doc_id, l.h AS leaf, s.h AS subroot, t.h AS root, sha256(g.way) AS proof_sha256, g.h AS folded_root,
       g.h = t.h AS verified
FROM l JOIN s ON s.name = l.tree JOIN g_end g USING (rid) CROSS JOIN (SELECT h FROM top WHERE n = 1) t
"""


ORACLE = {
    # the digest: each 5 hex digits of the SHA-1 are 4 letters of base32
    "op5_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
f AS (
  SELECT page_id, octet_length(encode(h)) AS payload_bytes, min(page_id) OVER (PARTITION BY h) AS first_id,
         [substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(x, (k // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - k % 4 * 5)::INT) & 31)::INT + 1, 1)
           FOR k IN range(0, 32)] AS letters
  FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, array_to_string(letters, '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
""",
    "op7_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
""",
    "op10_mixing": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, [3.0::DOUBLE, 1.0, 2.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM s),
l AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5
             - coalesce(sum(source_size) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE * 2.0)
            / sum(w) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW r AS (ORDER BY source_size / w, source ASC NULLS LAST)),
t AS (
  SELECT source, source_size,
         coalesce(least((SELECT max(level) FROM l WHERE level * w <= 2.0 * source_size) * w, source_size * 2.0),
                  source_size * 2.0) AS target,
         ('0x' || substr(md5('mix' || coalesce(':' || source, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM l),
k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) - 1 AS k FROM d),
e AS (
  SELECT k.doc_id, k.size, k.k, t.source_size, t.target, t.u,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS e
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, least(floor(e * (k + 1) + u) - floor(e * k + u), ceil(e))::BIGINT AS copies FROM e)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c
""",
    "op11_centroids": _centroid_sql(),
    "op13_merkle": _merkle_sql(),
    "op12_line_dedup": """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, generate_subscripts(lines, 1) AS i, unnest(lines) AS line FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (
  SELECT key, max(doc_id) AS keep FROM (SELECT DISTINCT key, doc_id FROM k WHERE length(key) >= 40)
  GROUP BY key HAVING count(*) >= 5),
j AS (SELECT k.*, g.key IS NOT NULL AND k.doc_id IS DISTINCT FROM g.keep AS gone FROM k LEFT JOIN g USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY rid, doc_id
""",
}
