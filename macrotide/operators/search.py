"""Ranked text search over an inverted index kept as tables (BM25).

``write_index`` counts each document's terms once. Postings lie in the order of their terms, so that a query
reads the row groups of its own terms and nothing else of the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from macrotide.operators.common import Names, as_list

# The usual weights of frequency and length.
FREQUENCY, LENGTH = 1.2, 0.75
TERM = r"[\p{L}\p{N}]+"
# Scores are compared to this many digits: the order in which terms are summed shows only behind them.
DIGITS = 9


def terms_of(*texts: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.concat_ws(" ", *texts)), F.lit(TERM), 0)


def write_index(docs: DataFrame, key: str, texts: Names, path: str) -> None:
    """The index of ``docs`` below ``path``: postings (term, key, tf, length) by term, and the number and total length of
    the documents with terms. A null text has none; rows of one key are one document."""
    words = docs.select(F.col(key).alias("key"), F.explode(terms_of(*[F.col(c) for c in as_list(texts)])).alias("term"))
    counted = words.groupBy("key", "term").agg(F.count(F.lit(1)).alias("tf"))
    lengths = counted.groupBy("key").agg(F.sum("tf").alias("length"))
    postings = counted.join(lengths, "key").select("term", "key", "tf", "length")
    postings.repartitionByRange("term", "key").sortWithinPartitions("term", "key").write.mode("overwrite").parquet(f"{path}/postings")
    lengths.agg(F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_terms")).write.mode("overwrite").parquet(f"{path}/totals")


def ranked_search(spark: SparkSession, path: str, queries: DataFrame, k: int, query_key: str = "query_id", text: str = "text") -> DataFrame:
    """The ``k`` most relevant documents of each query: rows (query_key, rank, key, score), equal scores by key. Queries without
    a known term give no rows; a term counts as often as the query has it.

    Only the postings of the queries' terms are read, and counted by term for their weights. The join
    is broadcast while the planner knows that the terms are few; a term of very many documents is split by adaptive execution."""
    postings = spark.read.parquet(f"{path}/postings")
    asked = queries.select(F.col(query_key).alias("_query"), F.explode(terms_of(F.col(text))).alias("term")).groupBy("_query", "term").agg(
        F.count(F.lit(1)).alias("times")
    )
    n_docs, n_terms = spark.read.parquet(f"{path}/totals").select("n_docs", "n_terms").first()
    if not n_docs:
        return spark.createDataFrame([], f"`{query_key}` {queries.schema[query_key].dataType.simpleString()}, rank int, key {postings.schema['key'].dataType.simpleString()}, score double")
    known = postings.join(asked.select("term").distinct(), "term", "left_semi")
    weights = known.groupBy("term").agg(F.count(F.lit(1)).alias("df")).withColumn(
        "weight", F.log(1 + (F.lit(float(n_docs)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    )
    weighted = asked.join(weights, "term").select("_query", "term", (F.col("times") * F.col("weight")).alias("weight"))
    damped = F.col("tf") + FREQUENCY * (1 - LENGTH + LENGTH * F.col("length") * n_docs / n_terms)
    scores = postings.join(weighted, "term").groupBy("_query", "key").agg(
        F.round(F.sum(F.col("weight") * F.col("tf") * (FREQUENCY + 1) / damped), DIGITS).alias("score")
    )
    best = Window.partitionBy("_query").orderBy(F.col("score").desc(), "key")
    ranked = scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select(F.col("_query").alias(query_key), "rank", "key", "score")
