"""The corpus pipeline: from all documents to shuffled shards of a mix.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents. Nulls, empty texts, repeated rows and extra columns are
treated as the operator of each stage says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm import decontaminate, language_id, mixing, ngram_join, sharding
from lodestat.llm.common import text_or_empty, whole_row, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str, least_score: float = 0.5) -> DataFrame:
    """Learn from the rows not held out; a row without a letter, or with no language at ``least_score``, goes."""
    model = language_id.fit(docs.where(~language_id.held_out()))
    rows = language_id.predict_languages(docs.select(whole_row(docs), "text"), model)
    known = (F.col("language.lang") != language_id.UNKNOWN) & (F.col("language.score") >= least_score)
    return rows.where(known).select("doc.*")


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar texts the row with the smallest id stays (of rows that repeat id and text, one)."""
    keepers = ngram_join.jaccard_classes(docs).select("keeper.doc_id", "keeper.text_key").distinct()
    keepers = keepers.withColumnsRenamed({"doc_id": "keeper_id", "text_key": "keeper_text"})
    rows = docs.select(whole_row(docs), F.col("doc_id").alias("row_id"), F.xxhash64(text_or_empty()).alias("row_text"))
    same = F.col("row_id").eqNullSafe(F.col("keeper_id")) & (F.col("row_text") == F.col("keeper_text"))
    return rows.join(keepers, same, "left_semi").dropDuplicates(["row_id", "row_text"]).select("doc.*")


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row that gives away a benchmark item goes."""
    rows = docs.select(whole_row(docs), "text")
    leaks = decontaminate.find_leaks(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return leaks.where(F.size("leaks") == 0).select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, always whole, as often as the mix takes it; rows of a source above its target go by quality-weighted draw."""
    return mixing.mixed_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), whole=True)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows shuffled into 40 shards; where each row is."""
    return sharding.digest(sharding.shard_documents(docs))


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", join_near_copies),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

ORACLE_SQL = None  # a trained model, a random walk over paths and a shuffle: tests hold every stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
