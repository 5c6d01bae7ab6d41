"""A training corpus from raw documents: each stage works on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import crf_quality, interleave, jaccard_join, latent_decontam, raking
from tidemill.llm.stage import settle


#: Rows without an id are numbered from here, or from behind the greatest id.
NAMELESS = 1 << 62


def _numbered(docs: DataFrame) -> tuple[DataFrame, int]:
    """The documents with a number in place of a missing id, so that each row without one is a document of its own; and where these numbers start."""
    seen = docs.agg(F.max("doc_id").alias("most"), F.count_if(F.col("doc_id").isNull()).alias("nameless")).first()
    first = max(NAMELESS, (seen.most or 0) + 1)
    if not seen.nameless:
        return docs, first
    # Written once, as numbers differ if they are made twice.
    own = settle(docs.filter("doc_id is null").withColumn("doc_id", F.lit(first) + F.monotonically_increasing_id()))
    return docs.filter("doc_id is not null").unionByName(own), first


def _only(docs: DataFrame, ids: DataFrame, first: int, how: str = "left_semi") -> DataFrame:
    """The documents whose id is in a column of ids (or not, by left_anti), numbers taken off again."""
    name = "_" * max(map(len, docs.columns)) + "id"  # not one of theirs
    ids = ids.select(F.col("doc_id").alias(name)).distinct()
    return _unnumbered(docs.join(ids, F.col("doc_id") == F.col(name), how), first)


def _unnumbered(docs: DataFrame, first: int) -> DataFrame:
    return docs.withColumn("doc_id", F.when(F.col("doc_id") < first, F.col("doc_id")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the base rules or the line labels reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs, first = _numbered(docs)
    kept = crf_quality.judge(docs, crf_quality.train(docs.filter(F.col("doc_id") < first), labels)).filter("kept").select("doc_id")
    return _only(docs, kept, first)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the least document of each component of similar ones (five-word shingles, similarity 0.8); documents without a shingle stay."""
    docs, first = _numbered(docs)
    kept = jaccard_join.jaccard_components(docs, k=5, percent=80).filter("component_id = doc_id").select("doc_id")
    return _only(docs, kept, first)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    docs, first = _numbered(docs)
    found = latent_decontam.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id")
    return _only(docs, found, first, "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents towards the target weights of source, language and topic."""
    docs, first = _numbered(docs)
    return _only(docs, raking.mix(docs).filter("kept").select("doc_id"), first)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their place in it."""
    docs, first = _numbered(docs)
    return _unnumbered(interleave.shard_documents(docs, shards=40), first)


STAGES = [("quality_rules", quality), ("ngram_jaccard_join", near_duplicates), ("benchmark_decontamination", decontaminate), ("mixing", mixing), ("sharding", sharding)]

#: The line labels and the latent space can't be expressed in SQL; each stage's operator is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
