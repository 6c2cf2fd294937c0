"""Connected components by alternating large and small stars (MapReduce form).

Edges are dealt by node with partial minima; nothing is collected. Each round is written to
the shared folder, so a lost executor costs one round at most. The links left fit ever fewer tasks:
each shuffle is written by as many as their number asks for, as a task writes its files however
few rows it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.session import checkpoint_root


LINKS_PER_TASK = 1 << 18


def in_tasks(df: DataFrame, rows: int, rows_per_task: int = LINKS_PER_TASK) -> DataFrame:
    """The rows in no more tasks than so many small ones need."""
    return df.coalesce(max(1, -(-rows // rows_per_task)))


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node of its component, for every node that has a link
    to another and is not itself the smallest. Links with a null end, to itself, and
    repeated or turned links change nothing."""
    checkpoint_root(links.sparkSession)
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))
    ).distinct().checkpoint()
    before = _fingerprint(edges)
    while True:
        edges, rows = in_tasks(edges, before[0]), 2 * before[0]
        # Large star: neighbours above a node are tied to the smallest node around it.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = in_tasks(in_tasks(large, rows).distinct(), rows)
        # Small star: neighbours below a node, and the node, are tied to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        edges = in_tasks(small, rows).distinct().checkpoint()
        after = _fingerprint(edges)
        if after == before:
            return in_tasks(edges, after[0]).select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = after
