"""The registered queries of this subpackage and their SQL on DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.llm import byte_cnn, decontamination, html_extraction, language_model, lexical_search, line_dedup, mixing, near_dedup
from macrotide.llm import quality_rules, substring_dedup, token_alignment, token_counts, url_filters
from macrotide.session import share_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def with_package(spark: SparkSession, sf_dir: str) -> DataFrame:
            share_package(spark)
            return run(spark, sf_dir)

        QUERIES[name] = with_package
        if sql is not None:
            ORACLES[name] = sql
        return with_package

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP1_SQL = f"""
WITH RECURSIVE rows_ AS MATERIALIZED (
  SELECT doc_id, coalesce(source, chr(0)) AS source, CAST(len({_WORDS.format("coalesce(text, '')")}) AS BIGINT) AS n_tokens FROM documents
), d AS MATERIALIZED (SELECT * FROM rows_ WHERE n_tokens > 0),
total AS (SELECT CAST(sum(n_tokens) AS BIGINT) AS total FROM d),
s AS MATERIALIZED (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY source),
sh AS MATERIALIZED (SELECT source, tokens, tokens / CAST(total AS DOUBLE) AS share FROM s, total),
grid AS (SELECT 0 AS k),
-- Entropy falls as the exponent grows: the largest one that still has 95 % of the possible entropy.
b1(i, lo, hi) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN (lo + hi) / 2 ELSE lo END, CASE WHEN ok THEN hi ELSE (lo + hi) / 2 END
  FROM (SELECT i, lo, hi, (SELECT ln(sum(pow(share, (lo + hi) / 2))) - sum(pow(share, (lo + hi) / 2) * ln(pow(share, (lo + hi) / 2)))
          / sum(pow(share, (lo + hi) / 2)) >= 0.95 * ln(count(*)) - 1e-12 FROM sh) AS ok FROM b1 WHERE i < 30)
), e1 AS (
  SELECT CASE WHEN (SELECT -sum(share * ln(share)) >= 0.95 * ln(count(*)) - 1e-12 FROM sh) THEN 1.0 ELSE (SELECT lo FROM b1 WHERE i = 30) END AS a
), b2(i, lo, hi) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN lo ELSE (lo + hi) / 2 END, CASE WHEN ok THEN (lo + hi) / 2 ELSE hi END
  FROM (SELECT i, lo, hi, (SELECT max(pow(share, (lo + hi) / 2) / share) / sum(pow(share, (lo + hi) / 2)) <= 4 + 1e-12 FROM sh) AS ok
        FROM b2 WHERE i < 30)
), e AS MATERIALIZED (
  SELECT CASE WHEN (SELECT max(pow(share, a) / share) / sum(pow(share, a)) <= 4 + 1e-12 FROM sh) THEN a
              WHEN (SELECT max(pow(share, 0.0) / share) / sum(pow(share, 0.0)) <= 4 + 1e-12 FROM sh) THEN 0.0
              ELSE (SELECT hi FROM b2 WHERE i = 30) END AS a FROM e1
), bud AS MATERIALIZED (
  SELECT source, CAST(b AS BIGINT) // tokens AS whole, CAST(b AS BIGINT) % tokens AS rest
  FROM (SELECT source, tokens, floor(round(pow(share, a) / (SELECT sum(pow(share, a)) FROM sh), 9) * total) AS b FROM sh, e, total)
), dealt AS MATERIALIZED (
  SELECT d.*, whole, rest, md5('mix/' || whole || '/' || d.source || '/' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM d JOIN bud USING (source)
), blk AS (
  SELECT source, substr(k, 1, 3) AS block, rest, sum(n_tokens) AS bt FROM dealt GROUP BY ALL
), bef AS (
  SELECT *, coalesce(sum(bt) OVER (PARTITION BY source ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM blk
), part AS (
  SELECT dealt.*, before, coalesce(sum(n_tokens) OVER (PARTITION BY dealt.source, block ORDER BY k, doc_id, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inner_
  FROM dealt JOIN bef ON dealt.source = bef.source AND substr(k, 1, 3) = block WHERE before < dealt.rest
), copies AS (
  SELECT doc_id, source, n_tokens, CAST(whole AS INTEGER) AS pass FROM part WHERE before + inner_ < rest
  UNION ALL SELECT doc_id, source, n_tokens, CAST(unnest(range(whole)) AS INTEGER) FROM dealt
), keyed AS (
  SELECT *, md5('mix/' || pass || '/' || source || '/' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM copies
)
SELECT doc_id, source, n_tokens, pass, substr(k, 1, 3) AS block, md5(k) AS place FROM keyed
"""


@query("op1_mix_sources", OP1_SQL)
def op1(spark, sf_dir):
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


OP2_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents
), s AS (
  SELECT doc_id, unnest([array_to_string(w[i:i+4], ' ') for i in range(1, greatest(1, len(w) - 4) + 1)]) AS s FROM w WHERE len(w) > 0
), c AS MATERIALIZED (SELECT doc_id, s, count(*) AS n FROM s GROUP BY ALL),
t AS MATERIALIZED (SELECT doc_id, sum(n) AS n FROM c GROUP BY ALL),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS i FROM c a JOIN c b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT a, b FROM p JOIN t x ON x.doc_id = a JOIN t y ON y.doc_id = b WHERE i / CAST(x.n + y.n - i AS DOUBLE) >= 0.8
), both_ AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.node, both_.b FROM r JOIN both_ ON r.other = both_.a
)
SELECT node AS doc_id, min(other) AS class_id FROM r GROUP BY node
"""


@query("op2_near_duplicate_classes", OP2_SQL)
def op2(spark, sf_dir):
    return near_dedup.near_duplicate_classes(table(spark, sf_dir, "documents"))


@query("op3_language_model_scores")
def op3(spark, sf_dir):
    return language_model.score_texts(table(spark, sf_dir, "documents"))


@query("op4_quality_scores")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = byte_cnn.train_quality(docs, table(spark, sf_dir, "labels"))
    return byte_cnn.score_quality(docs, model)


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, chr(0)) AS site, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), total AS (SELECT site, count(*) AS total FROM d GROUP BY site),
n AS (SELECT site, line, count(*) AS pages FROM (SELECT DISTINCT doc_id, site, unnest(lines) AS line FROM d) WHERE trim(line) <> '' GROUP BY ALL),
b AS (
  SELECT n.site, list(line) AS bad FROM n JOIN total USING (site) WHERE pages >= 5 AND pages > 0.1 * total GROUP BY n.site
), k AS (
  SELECT doc_id, text, lines, [x for x in lines if trim(x) = '' OR bad IS NULL OR NOT list_contains(bad, x)] AS kept
  FROM d LEFT JOIN b USING (site)
)
SELECT doc_id, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(lines) END AS BIGINT) AS n_lines,
  CAST(CASE WHEN text IS NULL THEN 0 ELSE len(lines) - len(kept) END AS BIGINT) AS n_dropped,
  CASE WHEN text IS NOT NULL THEN array_to_string(kept, chr(10)) END AS text FROM k
"""


@query("op5_drop_boilerplate_lines", OP5_SQL)
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate_lines(docs).select("doc_id", "n_lines", "n_dropped", "text")


@query("op6_token_counts")
def op6(spark, sf_dir):
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op7_remove_repeats")
def op7(spark, sf_dir):
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


OP8_SQL = rf"""
WITH d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), q AS MATERIALIZED (
  SELECT DISTINCT item, least(13, len(w)) AS width,
    unnest([array_to_string(w[i:i+12], ' ') for i in range(1, greatest(1, len(w) - 12) + 1)]) AS win
  FROM b WHERE len(w) > 0
), widths AS (SELECT DISTINCT width FROM q),
o AS (
  SELECT doc_id, width, unnest(range(1, len(w) - width + 2)) AS i, w FROM d, widths WHERE len(w) >= width
), hits AS MATERIALIZED (
  SELECT doc_id, i, o.width, item FROM o JOIN q ON q.width = o.width AND q.win = array_to_string(w[i:i+o.width-1], ' ')
), n AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + width)) AS p FROM hits) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(m.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n.n, 0) > 0 AND 20 * coalesce(n.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""


@query("op8_benchmark_hits", OP8_SQL)
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.benchmark_hits(docs, table(spark, sf_dir, "benchmark"))
    n_hit = decontamination.span_words(F.col("spans"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontamination.contaminated(n_hit, F.col("n_words")).alias("contaminated"),
    )


@query("op9_quality_rules")
def op9(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


RULES = """VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')"""

OP10_SQL = rf"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, instr(coalesce(url, ''), '://') AS mark FROM pages
), h AS (
  SELECT page_id, CASE WHEN mark > 0 THEN regexp_extract(substr(url, mark + 3), '^[^/?#]*') ELSE '' END AS raw,
    CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM p
), q AS (
  SELECT page_id, {_LOWER.format("raw")} AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h
), rules(host, path, verdict) AS ({RULES}),
f AS (
  SELECT page_id, q.host, q.path, r.host || r.path AS rule, r.verdict FROM q LEFT JOIN rules r
    ON (q.host = r.host OR ends_with(q.host, '.' || r.host)) AND starts_with(q.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM f
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST, verdict DESC, rule DESC) = 1
"""


@query("op10_url_verdicts", OP10_SQL)
def op10(spark, sf_dir):
    rules = spark.sql(f"SELECT * FROM {RULES} AS rules(host, path, verdict)")
    return url_filters.url_verdicts(table(spark, sf_dir, "pages"), rules)


OP11_SQL = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS row_, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{lexical_search.TERM}') AS w FROM documents
), i AS MATERIALIZED (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{lexical_search.TERM}')) AS term FROM benchmark) GROUP BY ALL
), t AS MATERIALIZED (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
f AS MATERIALIZED (
  SELECT row_, doc_id, n, term, count(*) AS tf FROM (SELECT row_, doc_id, len(w) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY ALL
), weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight FROM f, t GROUP BY term, n_docs),
impacts AS (
  SELECT row_, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)) AS impact FROM f, t
), s AS (
  SELECT item_id, doc_id, row_, CAST(sum(q * weight * impact) AS BIGINT) AS score
  FROM i JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER w <= 10
"""


@query("op11_ranked_search", OP11_SQL)
def op11(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_token_alignment")
def op12(spark, sf_dir):
    import public_tokenizers

    first, second = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.align_tokens(table(spark, sf_dir, "documents"), first, second)


@query("op13_html_main_text")
def op13(spark, sf_dir):
    return html_extraction.extract_text(table(spark, sf_dir, "pages"))
