"""The queries of this subpackage: each applies an operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import ball_negatives, crf_quality, fill_middle, html_blocks, interleave, jaccard_join, langid, latent_decontam, linededup, pii_bootstrap, raking, secret_ownership, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), k=4, percent=85)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return crf_quality.judge(docs, crf_quality.train(docs, _table(spark, sf_dir, "labels")))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave.assignments(_table(spark, sf_dir, "documents"), shards=40)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent_decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raking.mix(_table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ownership.scan(_table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(_table(spark, sf_dir, "pages"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_bootstrap.find(_table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(_table(spark, sf_dir, "documents"))
    restored = fill_middle.restore(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    return ball_negatives.mine(_table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label), scale=256)


_SPACE = r"[\x20\x09-\x0D]"

OP3_SQL = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(regexp_replace(regexp_replace(line, '^{_SPACE}+', ''), '{_SPACE}+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE doc_id > owner) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE owner IS NULL OR doc_id = owner), '')) AS kept_sha256
FROM k LEFT JOIN r USING (key) GROUP BY doc_id"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = [op1_ngram_jaccard_join, op2_language_id, op3_line_dedup, op4_quality_rules, op5_sharding, op6_benchmark_decontamination, op7_mixing, op8_secret_scan, op9_html_extraction, op10_pii, op11_fill_in_middle, op12_toxicity, op13_hard_negatives]
    return {f.__name__: f for f in made}


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": OP3_SQL, "op7_mixing": raking.mix_sql(), "op11_fill_in_middle": fill_middle.SQL, "op13_hard_negatives": ball_negatives.SQL}
