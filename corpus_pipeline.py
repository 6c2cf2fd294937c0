"""A training corpus from raw documents: STAGES one after another, each from Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.llm import byte_cnn, decontamination, line_dedup, mixing, near_dedup
from macrotide.session import scratch_dir, share_package

# The classifier, the signatures and the similarity classes are not SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    share_package(spark)
    model = byte_cnn.train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return byte_cnn.keep_quality(docs, model)


def line_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source. Copies count once: their
    duplicates go in the next stage, and with lines voted out by copies all of them would."""
    found = line_dedup.drop_boilerplate_lines(docs, distinct_texts=True)
    return found.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    share_package(spark)
    return near_dedup.keep_one_of_class(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    share_package(spark)
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The schedule of document copies, mixed to the target weights of the sources."""
    return mixing.mix_sources(docs, every_source=True)


STAGES = [
    ("quality", quality), ("line_boilerplate", line_boilerplate), ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages), ("mixture", mixture),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
