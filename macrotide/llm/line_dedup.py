"""Line dedup by site-relative frequency, in DataFrame functions alone.

For each site (host) the pages that hold a line are counted once each and divided by the
pages of the site. A line on over ``max_ratio`` of the pages is boilerplate of that site.

Only 16-byte digests of lines are shuffled, after a partial count in every task, so a site
or a line with a third of all rows sends a few rows for each task. With ``distinct_texts`` equal
texts of a site are one page, so copies do not vote their own lines into boilerplate; the line
digests of each distinct text are shuffled once for that. The boilerplate of a site
is at most its lines for each page divided by ``max_ratio``: one short array for each site.
It is written to the shared folder, so that the planner knows its size: a small table is
broadcast and no text moves; otherwise the join shuffles and splits hot sites.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.session import scratch_dir

NO_SITE = "\x00"


def _site(site_col: str) -> Column:
    return F.coalesce(F.col(site_col).cast("string"), F.lit(NO_SITE))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def site_boilerplate(
    docs: DataFrame, *, site_col: str = "source", text_col: str = "text", max_ratio: float = 0.1, min_pages: int = 5,
    distinct_texts: bool = False,
) -> DataFrame:
    """(site, digests): the lines on over ``max_ratio`` of a site's pages and on ``min_pages``
    pages at least. Lines of white space alone are not counted. Every row is a page, or with
    ``distinct_texts`` every distinct text of the site."""
    text = F.col(text_col).cast("string")
    digests = F.array_distinct(F.transform(F.filter(_lines(text), lambda x: F.trim(x) != ""), _digest))
    whole = _digest(F.coalesce(text, F.lit(""))).alias("page")
    sites, listed = docs.select(_site(site_col).alias("site")), docs.select(_site(site_col).alias("site"), digests.alias("digests"))
    if distinct_texts:
        sites = docs.select(_site(site_col).alias("site"), whole).distinct()
        listed = docs.select(_site(site_col).alias("site"), whole, digests.alias("digests")).groupBy("site", "page").agg(
            F.first("digests").alias("digests")
        )
    pages = sites.groupBy("site").agg(F.count(F.lit(1)).alias("total"))
    lines = listed.select("site", F.explode("digests").alias("digest"))
    counted = lines.groupBy("site", "digest").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min_pages)
    frequent = counted.join(pages, "site").where(F.col("pages") > max_ratio * F.col("total"))
    return frequent.groupBy("site").agg(F.collect_list("digest").alias("digests"))


def drop_boilerplate_lines(
    docs: DataFrame, *, site_col: str = "source", text_col: str = "text", max_ratio: float = 0.1, min_pages: int = 5,
    distinct_texts: bool = False,
) -> DataFrame:
    """``docs`` with the boilerplate lines of their site taken out of the text; the columns
    ``n_lines`` and ``n_dropped`` are added (replaced, if there).

    Null sites are one site of their own. A null text stays null and has no lines; an empty
    one has one. Texts that lose all lines become empty, and no row is dropped. Copies of a text are
    pages like others, and a group of them may lose all its lines, unless ``distinct_texts``."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "boilerplate")
    site_boilerplate(
        docs, site_col=site_col, text_col=text_col, max_ratio=max_ratio, min_pages=min_pages, distinct_texts=distinct_texts
    ).write.parquet(path)
    found = spark.read.parquet(path).select(F.col("site").alias("_site"), F.col("digests").alias("_digests"))
    text = F.col(text_col).cast("string")
    lines = _lines(text)
    kept = F.when(
        F.col("_digests").isNull(), lines
    ).otherwise(F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("_digests"), _digest(x))))
    joined = docs.join(found, _site(site_col) == F.col("_site"), "left")
    return (
        joined.withColumn("_kept", kept)
        .withColumns({
            "n_lines": F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("bigint"),
            "n_dropped": F.when(text.isNull(), 0).otherwise(F.size(lines) - F.size("_kept")).cast("bigint"),
        })
        .withColumn(text_col, F.when(text.isNotNull(), F.array_join("_kept", "\n")))
        .drop("_site", "_digests", "_kept")
    )
