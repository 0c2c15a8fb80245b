"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import line_spread, mixing, packing, simhash, toxicity
from lexmill.llm.queries import word_tokenizer
from lexmill.storage import materialize


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, scores as toxic go."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_spread_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each line that stands on five or more sources the first occurrence stays."""
    kept = line_spread.drop_spread_lines(docs, places="removed_lines")
    return kept.withColumn("n_chars", F.when(F.col("removed_lines").isNull(), F.col("n_chars")).otherwise(F.length("text"))).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are 0.8 similar on five-word shingles one stays."""
    return simhash.drop_near_duplicates(docs, shingle=5, similarity=0.8).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat as their source's tempered weight asks, in shuffled order."""
    return mixing.mix(docs).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 2048."""
    return packing.pack_documents(docs, word_tokenizer())


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_spread_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL can express neither the classifier nor the packing; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
