"""Registered queries of the subpackage (``QUERIES``) and their SQL twins
(``ORACLE``). Each query runs its operator over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (align, collision_search, compression, conversations, maxent, ngram_join, packing, pq_dedup, quality,
                           segment, substring, url_filter, warc)
from orderlens.llm.common import ship

URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.range(1).select(F.inline(F.array(*(
        F.struct(*(F.lit(v).alias(k) for k, v in zip(("host", "path", "verdict"), rule))) for rule in URL_RULES))))
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page.page_id", "host", "path", "rule", "verdict")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    weights = quality.fit(docs, labels.where(~quality.in_fold(F.col("doc_id"), 3, 1)), "quality")
    scored = quality.score(docs, weights)
    return scored.select("doc_id", quality.in_fold(F.col("doc_id"), 3, 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), packing.public_vocabulary())
    return packing.pack(pieces)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = warc.write_archives(pages)
    history = warc.merge_runs(warc.read_runs(spark, folder))
    return history.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.cut_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(table(spark, sf_dir, "documents"))


def op1_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return collision_search.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op5_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return segment.sample_segmentations(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), check=True)


def op8_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score_texts(table(spark, sf_dir, "documents"), quality.in_fold(F.col("doc_id"), 7, 2))


def op9_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.link(table(spark, sf_dir, "embeddings"))


def op11_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.judge_texts(table(spark, sf_dir, "documents"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(table(spark, sf_dir, "conversations")))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents"), *align.public_tokenizers_paths())


QUERIES = {f.__name__: f for f in (op1_collision_search, op2_warc, op3_packing, op4_ngram_join, op5_segment, op6_url_filter, op7_substring,
                                  op8_maxent, op9_pq_dedup, op10_quality, op11_compression,
                                  op12_repair, op13_align)}

ORACLE = {
    "op12_repair": """
WITH RECURSIVE crc AS (
  SELECT *, xor(list_reduce(flatten(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':'
        || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END) END,
      CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(coalesce(text, ' '), '.!?', '') ELSE coalesce(text, ' ') END AS text,
    unnest(range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM crc),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(role || ':' || text), copy) AS rn,
    left(role, 1) AS i, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM damaged),
faulty AS (
  SELECT *, CASE WHEN said = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 THEN 'duplicate'
      WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    lag(i) OVER (PARTITION BY conv_id ORDER BY rn) AS before FROM numbered),
r AS (
  SELECT conv_id, rn, i, role, text, fault IN ('blank', 'duplicate') IS TRUE AS gone, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS t FROM faulty),
-- cost to go from a state (0 nothing, 1 system, 2 user, 3 assistant said last) before row rn; an insertion costs 5
dp(conv_id, rn, b0, b1, b2, b3) AS (
  SELECT conv_id, max(rn) + 1, 0, 10, 5, 0 FROM r GROUP BY conv_id
  UNION ALL
  SELECT conv_id, rn, least(r0, 5 + r2, 10 + r3), least(r1, 5 + r2, 10 + r3), least(r2, 5 + r3), least(r3, 5 + r2) FROM (
    SELECT r.conv_id, r.rn,
      least(2 + b0, CASE WHEN gone THEN 1000000000 ELSE t + least(CASE i WHEN 's' THEN b1 WHEN 'u' THEN b2 ELSE 1000000000 END, 1 + b2) END) AS r0,
      least(2 + b1, CASE WHEN gone THEN 1000000000 ELSE t + least(CASE i WHEN 'u' THEN b2 ELSE 1000000000 END, 1 + b2) END) AS r1,
      least(2 + b2, CASE WHEN gone THEN 1000000000 ELSE t + least(CASE i WHEN 'a' THEN b3 ELSE 1000000000 END, 1 + b3) END) AS r2,
      least(2 + b3, CASE WHEN gone THEN 1000000000 ELSE t + least(CASE i WHEN 'u' THEN b2 ELSE 1000000000 END, 1 + b2) END) AS r3
    FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.rn = dp.rn - 1)),
-- the cheapest edits from the first row on: D before K before R (an insertion is never cheapest)
trace(conv_id, rn, s, audit, lines) AS (
  SELECT conv_id, 1, 0, '', CAST([] AS VARCHAR[]) FROM r GROUP BY conv_id
  UNION ALL
  SELECT conv_id, rn + 1, CASE e WHEN 'D' THEN s ELSE n END, audit || e,
    CASE e WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
      ELSE list_append(lines, CASE n WHEN 3 THEN 'assistant' ELSE 'user' END || ':' || text) END
  FROM (
    SELECT *, CASE WHEN 2 + after[s + 1] = now THEN 'D'
        WHEN (i = 's' AND s = 0) AND t + after[2] = now THEN 'K'
        WHEN ((i = 'u' AND s <> 2) OR (i = 'a' AND s = 2)) AND t + after[n0 + 1] = now THEN 'K' ELSE 'R' END AS e,
      CASE WHEN (i = 's' AND s = 0) AND 2 + after[s + 1] <> now AND t + after[2] = now THEN 1 ELSE n0 END AS n
    FROM (
      SELECT c.conv_id, c.rn, c.s, c.audit, c.lines, r.i, r.role, r.text, r.t, CASE c.s WHEN 2 THEN 3 ELSE 2 END AS n0,
        [a.b0, a.b1, a.b2, a.b3][c.s + 1] AS now, [z.b0, z.b1, z.b2, z.b3] AS after
      FROM trace c JOIN r ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.rn = c.rn
      JOIN dp a ON a.conv_id IS NOT DISTINCT FROM c.conv_id AND a.rn = c.rn
      JOIN dp z ON z.conv_id IS NOT DISTINCT FROM c.conv_id AND z.rn = c.rn + 1))),
counts AS (
  SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal, max(rn) AS n
  FROM faulty GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(dp.b0, 0) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN dp ON dp.conv_id IS NOT DISTINCT FROM o.conv_id AND dp.rn = 1
LEFT JOIN trace f ON f.conv_id IS NOT DISTINCT FROM o.conv_id AND f.rn = c.n + 1
""",
    "op9_pq_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
  AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e)
  WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
root AS (SELECT x, min(y) AS m FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT v.vec_id, coalesce(d.n, 0) AS n_links, least(v.vec_id, coalesce(r.m, v.vec_id)) AS component_id,
  v.vec_id = least(v.vec_id, coalesce(r.m, v.vec_id)) AS kept
FROM v LEFT JOIN root r ON v.vec_id = r.x LEFT JOIN degree d ON v.vec_id = d.x
""",
    "op2_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM f
""",
    "op6_url_filter": """
WITH rules(rhost, rpath, rverdict) AS (VALUES ('com','/','allow'), ('example.com','/en/','block'),
  ('www.example.com','/en/','allow'), ('net','/es/','block'), ('net','/fr/','block')),
parts AS (SELECT page_id,
  translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
hit AS (SELECT p.page_id, p.host, p.path, r.rhost || r.rpath AS rule, r.rverdict,
  row_number() OVER (PARTITION BY p.page_id, p.host, p.path ORDER BY length(r.rhost || r.rpath) DESC NULLS LAST) AS n
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM hit WHERE n = 1
""",
}
