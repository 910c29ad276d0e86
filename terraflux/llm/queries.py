"""The ``opN_*`` queries: each applies its operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.llm import alignment, decontaminate, hard_negatives, jaccard_join, langid, licenses, lm, mixing, quality, simhash, substring_dedup, token_counts, vafile
from terraflux.llm.shared import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(read(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return lm.score(docs, lm.train(docs))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return vafile.top_k(vectors, vectors.filter("vec_id % 100 = 0"), 10)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document in training order; ``position_k`` is the position of its k-th copy, null if it is not taken so often."""
    copies = [F.try_element_at("positions", F.lit(k)).alias(f"position_{k}") for k in range(1, mixing.MAX_REPEATS + 1)]
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken", *copies).orderBy(F.col("position_1").asc_nulls_last(), "doc_id")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.context_limits(token_counts.lengths_histogram(read(spark, sf_dir, "documents")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_sets(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_language_id": op4_language_id,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_mixing": op8_mixing,
    "op9_token_counts": op9_token_counts,
    "op10_decontamination": op10_decontamination,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_token_alignment": op12_token_alignment,
    "op13_jaccard_join": op13_jaccard_join,
}

def _shingles(table: str, key: str) -> str:
    words = "regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+')"
    pieces = "CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END"
    return f"SELECT DISTINCT r, {key}, unnest({pieces}) AS s FROM (SELECT row_number() OVER () AS r, {key}, {words} AS w FROM {table})"


ORACLE: dict[str, str] = {
    "op2_license_scan": licenses.oracle(),
    "op5_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
k AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 10""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM s WHERE same),
n AS (
  SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, k ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s ON p.anchor_id = s.anchor_id WHERE k <= 5 AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
    "op8_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
a AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
b AS (SELECT source, source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM a),
c AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest,
    CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS heavy
  FROM b WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST)),
e AS (SELECT *, cap * heavy <= rest * weight AS is_full FROM c),
l AS (SELECT rest, heavy FROM e WHERE NOT is_full ORDER BY heavy DESC LIMIT 1),
t AS (
  SELECT source, source_size, weight, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE CAST((SELECT rest FROM l) * weight AS DOUBLE) / (SELECT heavy FROM l) END AS target FROM e),
p AS (
  SELECT doc_id, d.source, size, source_size, target, weight, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o,
    CASE WHEN source_size > 0 THEN floor(floor(target) / source_size) ELSE 0 END AS whole
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
g AS (SELECT *, CAST(whole * size + greatest(0, least(floor(target) - whole * source_size - o, size)) AS BIGINT) AS taken FROM p),
n AS (  -- demand of light sources falls from 1.5 to 0.5 of its mean, that of heavy ones rises likewise
  SELECT CAST(sum(CASE weight WHEN 1 THEN 1.5 WHEN 2 THEN 1 ELSE 0.5 END * floor(target)) AS DOUBLE) AS u, CAST(sum(CASE weight WHEN 1 THEN -0.5 WHEN 2 THEN 0 ELSE 0.5 END * floor(target)) AS DOUBLE) AS v FROM t),
y AS (SELECT *, CASE WHEN taken > k * size THEN least(1, (k * source_size + o) / target) END AS y FROM g, (SELECT unnest([0, 1, 2]) AS k)),
x AS (SELECT *, CASE weight WHEN 2 THEN y WHEN 1 THEN (-1.5 + sqrt(2.25 + 4 * -0.5 * y)) / -1.0 ELSE (-0.5 + sqrt(0.25 + 4 * 0.5 * y)) / 1.0 END AS x FROM y),
w AS (SELECT *, (u * x + v * x * x) / (u + v) AS z FROM x, n)
SELECT doc_id, source, size, source_size, target, taken, max(CASE WHEN k = 0 THEN z END) AS position_1, max(CASE WHEN k = 1 THEN z END) AS position_2, max(CASE WHEN k = 2 THEN z END) AS position_3
FROM w GROUP BY doc_id, source, size, source_size, target, taken, o""",
    "op10_decontamination": f"""
WITH d AS ({_shingles("documents", "doc_id")}), b AS ({_shingles("benchmark", "item_id")}),
n AS (SELECT r, count(*) AS n FROM b GROUP BY r)
SELECT doc_id, item_id, count(*) AS shared, any_value(n.n) AS item_shingles, CAST(count(*) AS DOUBLE) / any_value(n.n) AS containment
FROM d JOIN b ON d.s = b.s JOIN n ON n.r = b.r GROUP BY d.r, b.r, doc_id, item_id HAVING count(*) >= 0.8 * any_value(n.n)""",
}
