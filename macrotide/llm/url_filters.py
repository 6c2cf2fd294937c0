"""URL filters: host suffixes and path prefixes, looked up by hash prefix.

Each distinct url is spread into the expressions ``host suffix + path prefix`` that a rule
could have. They meet the rules in an equi-join on the first bytes of their digest; the full
digest confirms a match. Of the rules that fit a url the longest wins, and of two equally
long ones a block. Rules are a DataFrame: the join broadcasts them only if their size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, ALLOW = "block", "allow"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(expression: Column) -> Column:
    return F.unhex(F.sha2(expression, 256))


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with their digests. Of rules repeated for one host and
    path a block stands; rules with a null part are left out, as they name no url."""
    expression = F.concat("host", "path")
    return (
        rules.select("host", "path", "verdict").dropna()
        .groupBy(expression.alias("rule")).agg(F.max("verdict").alias("rule_verdict"), F.first("path").alias("_path"))
        .withColumn("digest", _digest(F.col("rule")))
        .withColumn("short", F.substring("digest", 1, 4))
    )


def url_verdicts(
    pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url", default: str = ALLOW
) -> DataFrame:
    """One row for each page: page_id, host, path, the winning rule and its verdict.

    A rule fits its host and all hosts below it if the path begins with the rule's path. A url
    without a fitting rule, a null url or one without ``://`` has a null rule and the verdict
    ``default``. Repeated pages and null ids keep their rows; other columns are not read."""
    table = rule_table(rules)
    # The only path prefixes worth making are as long as some rule's path: one row, with at
    # most as many numbers as a path has characters.
    lengths = table.agg(F.collect_set(F.length("_path")).alias("lengths"))
    chosen = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url"))
    urls = chosen.select("_url").dropna().distinct().select(
        "_url", url_host(F.col("_url")).alias("_host"), url_path(F.col("_url")).alias("_path"),
    ).where(F.col("_host") != "")
    labels = F.split("_host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )
    prefixes = F.transform(
        F.filter(F.col("_lengths"), lambda n: n <= F.length("_path")), lambda n: F.substr(F.col("_path"), F.lit(1), n)
    )
    spread = (
        urls.withColumn("_lengths", lengths.scalar())
        .select("_url", F.explode(suffixes).alias("_suffix"), prefixes.alias("_prefixes"))
        .select("_url", "_suffix", F.explode("_prefixes").alias("_prefix"))
        .select("_url", F.concat("_suffix", "_prefix").alias("_expression"))
        .withColumn("_digest", _digest(F.col("_expression")))
        .withColumn("_short", F.substring("_digest", 1, 4))
    )
    fits = spread.join(table, (F.col("_short") == F.col("short")) & (F.col("_digest") == F.col("digest")))
    best = fits.groupBy("_url").agg(
        F.max(F.struct(F.length("rule").alias("n"), F.col("rule_verdict").alias("verdict"), F.col("rule").alias("rule")))
        .alias("best")
    )
    return chosen.join(best, "_url", "left").select(
        "page_id", url_host(F.col("_url")).alias("host"), url_path(F.col("_url")).alias("path"),
        F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
