"""Registered queries of the training-data operators: thin digests over the
operators' own results, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_bpe, centroids, chat_format, decontaminate, html_extract, language_id, merkle,
               mixing, quality_rules, secret_scan, simhash, token_store, toxicity)
from .common import Scratch, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs, fold=language_id.learned_fold())
    return language_id.predict(docs.withColumn("held_out", language_id.held_out()), model,
                               keep=("doc_id", "held_out"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digests(chat_format.format_turns(turns.unionByName(extra)))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold=toxicity.learned_fold())
    return toxicity.score(docs.withColumn("held_out", toxicity.held_out()), model,
                          keep=("doc_id", "held_out"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it holds."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Scratch(spark, 'token-store').base}/shards"
    token_store.write(table(spark, sf_dir, "documents"), path)
    return token_store.read_documents(spark, path)


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.check(table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        centroids.digest(F.col("centroid")).alias("centroid_sha256"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_secret_scan": op3_secret_scan,
    "op4_simhash": op4_simhash,
    "op5_chat_format": op5_chat_format,
    "op6_html_extract": op6_html_extract,
    "op7_toxicity": op7_toxicity,
    "op8_decontaminate": op8_decontaminate,
    "op9_quality_rules": op9_quality_rules,
    "op10_token_store": op10_token_store,
    "op11_mixing": op11_mixing,
    "op12_merkle": op12_merkle,
    "op13_centroids": op13_centroids,
}

# Centroid rounds of op13, one after the other.
_ROUND = """
d{0} AS (SELECT r, j, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
         FROM v, c{0}),
a{0} AS (SELECT r, arg_min(j, d * 16 + j) AS j, min(d) AS d FROM d{0} GROUP BY r)"""
_MOVE = """,
m{0} AS (SELECT j, i, CAST(floor(CAST(sum(x) AS BIGINT) // count(*)) AS BIGINT)
           - CASE WHEN sum(x) < 0 AND CAST(sum(x) AS BIGINT) % count(*) <> 0 THEN 1 ELSE 0 END AS x
         FROM (SELECT j, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{0} JOIN v USING (r)) GROUP BY j, i),
c{1} AS (SELECT c.j, coalesce(n.c, c.c) AS c
         FROM c{0} c LEFT JOIN (SELECT j, list(x ORDER BY i) AS c FROM m{0} GROUP BY j) n ON c.j = n.j),"""

ORACLE_SQL: dict[str, str] = {
    "op5_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
escaped AS (
  SELECT *, length('<s>[ROLE][/ROLE]</s>')
    + length(regexp_replace(role, '(?i)([<\[])(\\*)(/?s>|/?ROLE\]|/?INST\]|/?SYS\])', '\1\\\2\3', 'g'))
    + length(regexp_replace(text, '(?i)([<\[])(\\*)(/?s>|/?ROLE\]|/?INST\]|/?SYS\])', '\1\\\2\3', 'g')) AS size
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text))) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, md5(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id""",
    "op11_mixing": r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS t, md5(coalesce(text, '')) AS digest,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
keyed AS (
  SELECT doc_id, source, digest, size,
    -ln((CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || t), 1, 13) AS BIGINT)
              AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE))
    / greatest(CAST(length(regexp_replace(t, '[0-9!-/:-@\[-`{-~]', '', 'g')) AS DOUBLE) / greatest(length(t), 1)
               * (CAST(len(list_distinct(lines)) AS DOUBLE) / len(lines)), CAST(0.05 AS DOUBLE)) AS key
  FROM docs),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM keyed GROUP BY source),
ranked AS (
  SELECT *, CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS w,
    CAST(2 * source_size AS DOUBLE) AS top FROM sizes),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY top / w, source NULLS LAST) AS k, (SELECT CAST(1.5 AS DOUBLE) * sum(source_size) FROM sizes) AS total,
    coalesce(sum(top) OVER before, 0) AS topped, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS open
  FROM ranked
  WINDOW before AS (ORDER BY top / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rate AS (SELECT coalesce(arg_min((total - topped) / open, k) FILTER ((total - topped) / open < top / w), 1e300) AS rate FROM ordered),
asked AS (SELECT source, source_size, least(top, w * rate) AS target FROM ranked, rate),
split AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM asked),
run AS (
  SELECT k.doc_id, k.size, s.source_size, s.target, s.epochs,
    CAST(round(s.target - s.epochs * s.source_size) AS BIGINT) AS rest,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id NULLS FIRST, k.digest
                      ROWS UNBOUNDED PRECEDING) - k.size AS before
  FROM keyed k JOIN split s ON k.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(least(rest - before, size), 0) AS BIGINT) AS taken FROM run""",
    "op12_merkle": r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, *, CAST(doc_id AS VARCHAR) AS id,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
  FROM documents),
hashed AS (
  SELECT r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) AS cut,
    coalesce(list_reduce([4294967295] || list_transform(range(1, length(id) + 1), lambda i: ascii(substr(id, CAST(i AS INTEGER), 1))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, z: xor(s >> 1, 3988292384 * (s & 1)))) & 1, 0) AS odd
  FROM docs),
places AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS p FROM hashed),
-- the crc ends in an exclusive or with ones, so its last bit is 0 where the register's is 1
leaves AS (SELECT *, CASE WHEN odd = 1 THEN cut ELSE leaf END AS altered FROM places),
nodes AS (
  SELECT tree, 0 AS level, p, n, leaf AS h FROM leaves
  UNION ALL
  SELECT tree, level + 1, p // 3, max(n + 2) // 3, sha256(string_agg(h, '' ORDER BY p))
  FROM nodes WHERE n > 1 GROUP BY tree, level, p // 3),
subroots AS (SELECT tree, h, level FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, tree AS p, (SELECT count(*) FROM subroots) AS n, h FROM subroots
  UNION ALL
  SELECT level + 1, p // 3, max(n + 2) // 3, sha256(string_agg(h, '' ORDER BY p)) FROM tops WHERE n > 1
  GROUP BY level, p // 3),
steps AS (
  SELECT tree, level, p, string_agg(h, '' ORDER BY p) OVER before AS lefts, string_agg(h, '' ORDER BY p) OVER after AS rights
  FROM nodes WHERE n > 1
  WINDOW before AS (PARTITION BY tree, level, p // 3 ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (PARTITION BY tree, level, p // 3 ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
top_steps AS (
  SELECT level, p, string_agg(h, '' ORDER BY p) OVER before AS lefts, string_agg(h, '' ORDER BY p) OVER after AS rights
  FROM tops WHERE n > 1
  WINDOW before AS (PARTITION BY level, p // 3 ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (PARTITION BY level, p // 3 ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
climb AS (
  SELECT r, tree, 0 AS level, p, altered AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT c.r, c.tree, c.level + 1, c.p // 3, sha256(coalesce(lefts, '') || c.h || coalesce(rights, '')),
    c.proof || coalesce(lefts, '') || coalesce(rights, '')
  FROM climb c JOIN steps s ON s.tree = c.tree AND s.level = c.level AND s.p = c.p),
over AS (
  SELECT c.r, 0 AS level, c.tree AS p, c.h, c.proof FROM climb c JOIN subroots s ON s.tree = c.tree AND s.level = c.level
  UNION ALL
  SELECT c.r, c.level + 1, c.p // 3, sha256(coalesce(lefts, '') || c.h || coalesce(rights, '')),
    c.proof || coalesce(lefts, '') || coalesce(rights, '')
  FROM over c JOIN top_steps s ON s.level = c.level AND s.p = c.p)
SELECT l.doc_id, l.leaf, s.h AS subroot, t.h AS root, sha256(o.proof) AS proof_sha256, o.h AS folded_root, o.h = t.h AS verified
FROM leaves l JOIN subroots s USING (tree) CROSS JOIN (SELECT h, level FROM tops WHERE n = 1) t
JOIN over o ON o.r = l.r AND o.level = t.level""",
    "op13_centroids": r"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), vec_id NULLS FIRST, v) - 1 AS j, v AS c
  FROM v QUALIFY j < 16),""" + "".join(_ROUND.format(k) + _MOVE.format(k, k + 1) for k in range(3)) + _ROUND.format(3) + """
SELECT v.vec_id, CAST(a.j AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a3 a JOIN v USING (r) JOIN c3 c ON c.j = a.j""",
}
