"""Ranked lexical search: the highest-scoring documents of each query, by norm buckets.

A score is an inner product: what a term gives in a document (its impact) times the term's weight and
its repeats in the query. Only terms of queries matter, so a document is a short vector
over them. Vectors are written in the order of their length, longest first, so every file
and every stretch of a file is a bucket of similar lengths.

The longest vectors are searched first. They give each query a score that ten documents reach.
A bucket whose longest vector cannot reach it by the Cauchy-Schwarz inequality is left out, the
shortest ones already by the scan. Inside a bucket a query's heaviest coordinates are summed first:
their sum plus the bound for the others filters documents, and those that stay are scored in integers.
Floats only choose whom to score: bounds are raised by more than their error.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from macrotide.llm.text import LOWER, text_bytes
from macrotide.session import scratch_dir

# The characters of a term, for Java's and for Python's byte patterns, and the letters made lower case.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
NO_TERM_BYTES = re.compile(rb"[^0-9A-Za-z\x80-\xFF]")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Fixed values of the score: weights of length and frequency.
LENGTH_SHARE, IMPACT = 75, 1_000_000_000

PIECE_BYTES = 4 << 20
BUCKET_ROWS = 4096
FOCUS = 4  # coordinates summed before each bound
NO_ID = np.iinfo(np.int64).max
VECTOR = "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>"
FOUND = "item int, doc_id bigint, score bigint"


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower()), F.lit(TERM), 0)


def count_terms(text: bytes) -> tuple[int, Counter]:
    """All terms of a text. A long text is counted in pieces that end between terms."""
    at, n, counts = 0, 0, Counter()
    while at < len(text):
        cut = NO_TERM_BYTES.search(text, at + PIECE_BYTES)
        end = cut.start() if cut else len(text)
        found = TERM_BYTES.findall(text[at:end].translate(LOWER.tobytes()))
        n += len(found)
        counts.update(found)
        at = end
    return n, counts


def query_vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """For each document with terms: how many, and those of the vocabulary with their frequencies."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            keep, sizes, terms, tfs = [], [], [], []
            for row, (x, y) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                n, counts = count_terms(data[x:y].tobytes())
                if n:
                    found = sorted((vocabulary[t], c) for t, c in counts.items() if t in vocabulary)
                    keep.append(row)
                    sizes.append((n, len(found)))
                    terms.extend(t for t, _ in found)
                    tfs.extend(c for _, c in found)
            if keep:
                ns, lens = np.array(sizes, np.int64).T
                at = pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(keep)), pa.array(ns), pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                     pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64()))],
                    names=["doc_id", "n", "terms", "tfs"],
                )

    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(rows, VECTOR)


@dataclass
class Queries:
    """A block of queries over a vocabulary: coordinates heaviest first, and the score each has to reach."""

    terms: list[np.ndarray]
    weights: list[np.ndarray]  # weight times repeats: what the exact score multiplies
    roots: np.ndarray  # root of each term's weight
    reach: np.ndarray

    def coordinates(self, item: int) -> np.ndarray:
        root = self.roots[self.terms[item]]
        return np.divide(self.weights[item], root, out=np.zeros(len(root)), where=root > 0)


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search_bucket(
    queries: Queries, lengths: np.ndarray, terms: np.ndarray, values: np.ndarray, owner: np.ndarray, ids: np.ndarray,
    tops: list[tuple[np.ndarray, np.ndarray]], k: int,
) -> None:
    """Let the documents of one bucket into the best of each query. ``terms`` (ascending), ``values``
    and ``owner`` are the bucket's entries by term."""
    begin, end = np.searchsorted(terms, np.arange(len(queries.roots))), np.searchsorted(terms, np.arange(len(queries.roots)), "right")
    longest, squares = lengths.max(initial=0.0), lengths**2
    for item, names in enumerate(queries.terms):
        x = queries.coordinates(item)
        rest = float(np.sqrt((x**2).sum()))
        reach = max(int(queries.reach[item]), int(tops[item][1][-1]) if len(tops[item][0]) == k else 1)
        if rest * longest * (1 + 1e-9) + 1 < reach:
            continue
        left, part, own = None, np.zeros(len(lengths)), np.zeros(len(lengths))
        for first in range(0, len(names), FOCUS):
            for t, weight in zip(names[first : first + FOCUS].tolist(), x[first : first + FOCUS].tolist(), strict=True):
                here = owner[begin[t] : end[t]]
                got = values[begin[t] : end[t]] * queries.roots[t]
                part[here] += weight * got
                own[here] += got**2
            rest = float(np.sqrt((x[first + FOCUS :] ** 2).sum()))
            bound = (part + rest * np.sqrt(np.maximum(squares - own, 0) + squares * 1e-9)) * (1 + 1e-9) + 1
            left = np.flatnonzero(bound >= reach) if left is None else left[bound[left] >= reach]
            if not len(left) or len(left) * len(names) < len(lengths):
                break
        if left is None or not len(left):
            continue
        chosen = np.zeros(len(lengths), bool)
        chosen[left] = True
        exact = np.zeros(len(lengths), np.int64)
        for t, weight in zip(names.tolist(), queries.weights[item].tolist(), strict=True):
            here = owner[begin[t] : end[t]]
            stays = chosen[here]
            exact[here[stays]] += weight * values[begin[t] : end[t]][stays]
        left = left[exact[left] > 0]
        all_ids, all_scores = np.concatenate([tops[item][0], ids[left]]), np.concatenate([tops[item][1], exact[left]])
        order = best_of(all_ids, all_scores, k)
        tops[item] = all_ids[order], all_scores[order]


def search_part(vectors: DataFrame, queries: Queries, k: int) -> DataFrame:
    """The best of each query in each task, from vectors (doc_id, terms, impacts, length)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.zeros(0, np.int64)
        tops = [(nothing, nothing) for _ in queries.terms]
        for batch in batches:
            for at in range(0, len(batch), BUCKET_ROWS):
                bucket = batch.slice(at, BUCKET_ROWS)
                flat, sizes = bucket.column(1), bucket.column(1).value_lengths().to_numpy()
                terms, values = flat.flatten().to_numpy(), bucket.column(2).flatten().to_numpy()
                order = np.argsort(terms, kind="stable")
                owner = np.repeat(np.arange(len(bucket)), sizes)[order]
                ids = bucket.column(0).fill_null(NO_ID).to_numpy()
                search_bucket(queries, bucket.column(3).to_numpy(), terms[order], values[order], owner, ids, tops, k)
        for item, (ids, scores) in enumerate(tops):
            if len(ids):
                known = pa.array(ids, mask=ids == NO_ID)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), item, np.int32)), known, pa.array(scores)], names=["item", "doc_id", "score"]
                )

    return vectors.select("doc_id", "terms", "impacts", "length").mapInArrow(rows, FOUND)


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each item, ranked: first in salted parts, so no item gathers all tasks' rows."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = found.withColumn("salt", F.spark_partition_id() % 64)
    part = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).filter(F.col("rank") <= k)
    ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def _search_block(docs: DataFrame, items: list, k: int, id_col: str, text_col: str, head_rows: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t.encode() for r in items for t in r["counts"]}))}
    path = scratch_dir(spark, "search-vectors")
    query_vectors(docs, vocabulary, id_col, text_col).write.parquet(path)
    vectors = spark.read.schema(VECTOR).parquet(path)
    n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for term, n in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row for each query term
        df[term] = n
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    roots = np.sqrt(weights.astype(float))

    terms, weighted = [], []
    for row in items:
        ids = np.array([vocabulary[t.encode()] for t in row["counts"]], np.int64)
        total = weights[ids] * np.array(list(row["counts"].values()), np.int64)
        order = np.lexsort((ids, -total))
        terms.append(ids[order])
        weighted.append(total[order])
    queries = Queries(terms, weighted, roots, np.ones(len(items), np.int64))

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sizes = batch.column(1).to_numpy(), batch.column(2).value_lengths().to_numpy()
            m = 100 - LENGTH_SHARE + LENGTH_SHARE * n * n_docs // n_terms
            names, tf = batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy()
            owner = np.repeat(np.arange(len(batch)), sizes)
            impacts = IMPACT * tf // (1000 * tf + 8 * m[owner])
            length = np.sqrt(np.bincount(owner, (impacts * roots[names]) ** 2, len(batch)))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(names)), pa.ListArray.from_arrays(offsets, pa.array(impacts)),
                 pa.array(length)], names=["doc_id", "terms", "impacts", "length"],
            )

    kind = "doc_id bigint, terms array<int>, impacts array<bigint>, length double"
    measured = vectors.mapInArrow(lengths, kind).filter(F.col("length") > 0)
    path = scratch_dir(spark, "search-by-length")
    measured.repartitionByRange(F.col("length").desc(), F.col("doc_id")).sortWithinPartitions(F.col("length").desc()).write.parquet(path)
    ordered = spark.read.schema(kind).parquet(path)

    # Buckets of lengths a sixteenth of an octave apart: few rows, whatever the number of documents.
    steps = ordered.groupBy(F.floor(F.log2("length") * 16).alias("step")).count().collect()
    cut, seen = 0.0, 0
    for step, n in sorted(steps, reverse=True):
        seen += n
        if seen >= head_rows:
            cut = 2.0 ** (step / 16)
            break
    head = best(search_part(ordered.filter(F.col("length") >= cut), queries, k), k)
    path = scratch_dir(spark, "search-head")
    head.write.parquet(path)
    head = spark.read.schema("item int, rank int, doc_id bigint, score bigint").parquet(path)
    for item, score in head.filter(F.col("rank") == k).select("item", "score").collect():  # at most one row for each query
        queries.reach[item] = score
    norms = np.array([float(np.sqrt((queries.coordinates(i) ** 2).sum())) for i in range(len(items))])
    shortest = min((r / n for r, n in zip(queries.reach, norms, strict=True) if n > 0), default=0.0) * (1 - 1e-6) - 1e-3
    tail = search_part(ordered.filter((F.col("length") < cut) & (F.col("length") >= shortest)), queries, k)
    found = best(head.select("item", "doc_id", "score").unionByName(tail), k)
    names = spark.createDataFrame([(i, r["place"]) for i, r in enumerate(items)], "item int, place bigint")
    return found.join(names, "item").drop("item")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, *, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_pairs: int = 1 << 20, head_rows: int = 8192,
) -> DataFrame:
    """The ``k`` best documents of each item: rows (item_id, rank, doc_id, score), rank 1 the best.

    A null text has no terms; a document without terms counts nowhere, an item without terms or without a document of
    score above 0 gives no rows, as do empty tables. Repeated ids are documents of their own and may
    both be listed; equal scores go by ascending id, rows without an id last. Each item row is a query of its own,
    also where ids repeat or are null. Other columns are not read.

    Items are searched in blocks of about ``block_pairs`` (item, term) pairs, or of one item, which is what
    the driver and the tasks hold at a time. Every block reads all documents."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "search-items")
    placed = items.select(F.monotonically_increasing_id().alias("place"), F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    placed.select("place", "item_id", terms_of(F.col("text")).alias("terms")).write.parquet(path)
    placed = spark.read.parquet(path)
    counted = placed.select("place", F.explode("terms").alias("term")).groupBy("place", "term").count()
    pairs = counted.groupBy("place").agg(F.map_from_entries(F.collect_list(F.struct("term", "count"))).alias("counts"))
    total = placed.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = -(-total // block_pairs)
    parts = []
    for block in range(blocks):
        rows = pairs.filter(F.pmod(F.xxhash64("place"), F.lit(blocks)) == block).collect()
        if rows:
            parts.append(_search_block(docs, rows, k, id_col, text_col, head_rows))
    if not parts:
        kind = placed.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.join(placed.select("place", "item_id"), "place").select("item_id", "rank", "doc_id", "score")
