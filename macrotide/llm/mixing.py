"""Mixing sources to target weights by temperature.

A source's share of all tokens is raised to an exponent and normalised. The exponent is
found by bisection: the largest one (closest to the natural shares) at which the weights
reach a target entropy, or the smallest at which no source is repeated too often. Weights
become token budgets, and budgets are realised as permutations of blocks: a source is dealt
by hash into blocks, and each pass over a source takes its blocks in a new order until the
budget is used.

Whole passes need no order at all. Only the last, partial pass does: a running sum over a
source's block sums finds the block in which the budget ends, and a running sum
over the documents of this one block finds the last document. So a source with a third of
all rows is never ordered in one task; ``block_digits`` (hex) sets how small a block is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from macrotide.session import checkpoint_root

NO_SOURCE = "\x00"
LEVELS, PASSES = 5, 6  # halvings found by one pass over the shares, and passes


def word_count(text: Column) -> Column:
    """Words divided by ASCII white space; none in a null text."""
    words = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.regexp_replace(words, r"[\x20\x09-\x0D]+", "")).cast("bigint")


def source_tokens(docs: DataFrame, source_col: str, tokens: Column) -> DataFrame:
    return docs.groupBy(F.coalesce(F.col(source_col).cast("string"), F.lit(NO_SOURCE)).alias("source")).agg(
        F.sum(tokens).alias("tokens"), F.count(F.lit(1)).alias("n_docs")
    ).where(F.col("tokens") > 0)


def _measures(shares: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float, float, int]]:
    """For each exponent: entropy of the weights, largest weight over share, ..., sources."""
    raised = shares.select("share", F.explode(F.lit(exponents)).alias("a")).withColumn("p", F.pow("share", "a"))
    per = raised.groupBy("a").agg(
        F.sum("p").alias("z"), F.sum(F.col("p") * F.log("p")).alias("plogp"),
        F.max(F.col("p") / F.col("share")).alias("ratio"), F.count(F.lit(1)).alias("n"),
    )
    return {
        r.a: (r.ln_z - r.plogp / r.z, r.ratio / r.z, r.z, r.n)
        for r in per.withColumn("ln_z", F.log("z")).collect()  # one row for each exponent
    }


def find_exponent(
    shares: DataFrame, *, entropy_ratio: float | None = None, max_passes: float | None = None, volume: float = 1.0
) -> float:
    """Exponent between 0 and 1, to 2**-30, by bisection; ``shares`` has a column ``share``.

    With ``entropy_ratio`` the largest exponent whose entropy is at least that part of the
    logarithm of the number of sources. With ``max_passes`` too, an exponent that repeats a
    source more often (``volume`` is the budget over all tokens) is raised until it does not."""
    low_goal, low = (lambda m: m[0] >= entropy_ratio * _ln(m[3]) - 1e-12), 1.0
    if entropy_ratio is not None:
        low = _bisect(shares, low_goal, upward=True)
    if max_passes is not None:
        within = lambda m: m[1] * volume <= max_passes + 1e-12
        if not within(_measures(shares, [low])[low]):
            low = _bisect(shares, within, upward=False)
    return low


def _ln(n: int) -> float:
    import math

    return math.log(n)


def _bisect(shares: DataFrame, holds, upward: bool) -> float:
    """``upward``: the largest exponent at which ``holds``, which is true at 0; otherwise the
    smallest, for what is true at 1. Each pass asks for all midpoints of the next halvings."""
    edge = 1.0 if upward else 0.0
    if holds(_measures(shares, [edge])[edge]):
        return edge
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        parts = 1 << LEVELS
        points = [low + (high - low) * k / parts for k in range(1, parts)]
        found = _measures(shares, points)
        for _ in range(LEVELS):
            middle = (low + high) / 2
            if holds(found[middle]) == upward:
                low = middle
            else:
                high = middle
    return low if upward else high


def mix_sources(
    docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    entropy_ratio: float = 0.95, max_passes: float = 4.0, volume: float = 1.0, block_digits: int = 3, seed: str = "mix",
    every_source: bool = False,
) -> DataFrame:
    """One row for each scheduled copy of a document: doc_id, source, n_tokens, pass (from 0),
    block (hex digits) and place, a key by which the copies are in mixed order.

    Budgets are ``volume`` times all tokens, dealt by weight. A source takes whole passes
    while they fit, and of the next pass its blocks in that pass's order, up to the document
    that reaches the budget. Weights are rounded to 9 decimals, so a source may have a budget of
    nothing; with ``every_source`` it still gives one document. Ties of the order are broken by id. Documents without words weigh nothing
    and are not scheduled. A null source is one of its own, named by a NUL character. Null
    ids and repeated rows are scheduled like others; other columns are not read."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(source_col).cast("string"), F.lit(NO_SOURCE)).alias("source"),
        word_count(F.col(text_col).cast("string")).alias("n_tokens"),
    ).where(F.col("n_tokens") > 0)
    checkpoint_root(spark)
    rows = rows.checkpoint()
    sources = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).checkpoint()
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return rows.select(
            "doc_id", "source", "n_tokens", F.lit(0).alias("pass"), F.lit("").alias("block"), F.lit("").alias("place")
        ).limit(0)
    shares = sources.withColumn("share", F.col("tokens") / F.lit(float(total)))
    exponent = find_exponent(shares, entropy_ratio=entropy_ratio, max_passes=max_passes, volume=volume)
    norm = _measures(shares, [exponent])[exponent][2]
    budget = F.floor(F.round(F.pow("share", F.lit(exponent)) / F.lit(norm), 9) * F.lit(volume * total))
    budgets = shares.select(
        "source", "tokens", (F.greatest(budget, F.lit(1)) if every_source else budget).alias("budget")
    ).select("source", F.floor(F.col("budget") / F.col("tokens")).alias("whole"), (F.col("budget") % F.col("tokens")).alias("rest"))

    def key(number: Column) -> Column:
        return F.md5(F.concat_ws("/", F.lit(seed), number.cast("string"), "source", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))

    dealt = rows.join(budgets, "source").withColumn("_key", key(F.col("whole")))
    last = dealt.withColumn("block", F.substring("_key", 1, block_digits))
    per_block = last.groupBy("source", "block", "rest").agg(F.sum("n_tokens").alias("block_tokens"))
    order = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = per_block.withColumn("before", F.coalesce(F.sum("block_tokens").over(order), F.lit(0))).where(
        F.col("before") < F.col("rest")
    ).select("source", "block", "before", (F.col("before") + F.col("block_tokens") > F.col("rest")).alias("cut"))
    taken = last.join(before, ["source", "block"])
    inside = Window.partitionBy("source", "block").orderBy("_key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    partial = taken.where(~F.col("cut")).unionByName(
        taken.where("cut").withColumn("_sum", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .where(F.col("before") + F.col("_sum") < F.col("rest")).drop("_sum")
    ).select("doc_id", "source", "n_tokens", F.col("whole").cast("int").alias("pass"))
    full = dealt.where("whole > 0").select(
        "doc_id", "source", "n_tokens", F.explode(F.sequence(F.lit(0), F.col("whole").cast("int") - 1)).alias("pass")
    )
    copies = full.unionByName(partial).withColumn("_key", key(F.col("pass")))
    return copies.select(
        "doc_id", "source", "n_tokens", "pass", F.substring("_key", 1, block_digits).alias("block"), F.md5("_key").alias("place")
    )
