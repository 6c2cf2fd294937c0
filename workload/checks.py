"""Data-quality checks (Q)."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from macrotide.operators import joins, quality as q
from macrotide.plans import gate
from macrotide.session import scratch_dir
from workload import standins as st
from workload.registry import query, r6, rounded, table
from workload.standins import SERIES_ROWS, with_


@query("q1_check_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def q1(spark, sf):
    return q.check_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("q2_check_fk", """
SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size > 5)""")
def q2(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return q.check_fk(lines, table(spark, sf, "part").filter(F.col("p_size") > 5), "l_partkey", "p_partkey")


@query("q3_check_not_null", with_(SERIES_ROWS) + """
, bounds AS (SELECT series_key, min(date) AS lo, max(date) AS hi FROM series GROUP BY 1),
days AS (SELECT series_key, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds)
SELECT series_key, date, numeric_value FROM days LEFT JOIN series USING (series_key, date) WHERE numeric_value IS NULL""")
def q3(spark, sf):
    points = st.series(spark, sf).select("series_key", "date", "numeric_value")
    return q.check_not_null(joins.densify(points, "series_key"), "numeric_value")


@query("q4_check_range", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice < 2000 OR l_extendedprice > 90000""")
def q4(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return q.check_range(lines, "l_extendedprice", 2000.0, 90000.0)


@query("q5_check_accepted", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def q5(spark, sf):
    return q.check_accepted(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O"])


@query("q5_verdict", """
SELECT 'status is F or O' AS "check", count(*) AS n_failing, count(*) = 0 AS passed
FROM orders WHERE o_orderstatus NOT IN ('F', 'O')""")
def q5_verdict(spark, sf):
    return q.verdict(q.check_accepted(table(spark, sf, "orders"), "o_orderstatus", ["F", "O"]), "status is F or O")


@query("q6_check_freshness", """
SELECT user_id, newest, CAST(floor(age / 3600) AS BIGINT) AS age_hours, age > 12 * 3600 AS is_stale
FROM (SELECT user_id, max(ts) AS newest, epoch(TIMESTAMP '2024-01-31 00:00:00' - max(ts)) AS age FROM events GROUP BY user_id)""")
def q6(spark, sf):
    return q.check_freshness(table(spark, sf, "events"), "user_id", "ts", "2024-01-31 00:00:00", 12)


@query("q7_check_outliers", f"""
WITH named AS (SELECT event_id, value, NULLIF(event_type, 'error') AS event_type FROM events),
stats AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS sd FROM named GROUP BY 1)
SELECT event_id, e.event_type, value, {r6('(value - m) / NULLIF(sd, 0)')} AS z
FROM named e JOIN stats s ON e.event_type IS NOT DISTINCT FROM s.event_type WHERE abs((value - m) / NULLIF(sd, 0)) > 4""")
def q7(spark, sf):
    """One type's events have no key; they are a group of their own."""
    kind = F.nullif("event_type", F.lit("error")).alias("event_type")
    events = table(spark, sf, "events").select("event_id", kind, "value")
    return rounded(q.check_outliers(events, "event_type", "value"), "z")


@query("q8_completeness", with_(SERIES_ROWS) + """
, flagged AS (SELECT *, CASE WHEN numeric_value < 200000 THEN numeric_value END AS small FROM series)
SELECT series_key, count(*) AS observed_days, CAST(max(date) - min(date) + 1 AS BIGINT) AS expected_days,
  count(small) / CAST(count(*) AS DOUBLE) AS small_share, count(*) / CAST(max(date) - min(date) + 1 AS DOUBLE) AS day_share
FROM flagged GROUP BY 1""")
def q8(spark, sf):
    flagged = st.series(spark, sf).withColumn("small", F.when(F.col("numeric_value") < 200000, F.col("numeric_value")))
    return q.completeness(flagged, "series_key", cols="small")


@query("q9_reconcile_counts", """
SELECT l_orderkey, CAST(max(l_linenumber) AS BIGINT) AS declared_count, count(*) AS actual_count FROM lineitem
GROUP BY 1 HAVING max(l_linenumber) <> count(*)""")
def q9(spark, sf):
    """The highest line number stands for the declared count of an order."""
    batches = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_linenumber").cast("bigint").alias("declared_count"), F.count(F.lit(1)).alias("actual_count")
    )
    return q.reconcile_counts(batches)


@query("q10_run_completeness", """
WITH runs AS (SELECT DISTINCT strftime(date_trunc('hour', ts), '%Y%m%d_%H%M%S') AS collection_timestamp FROM events),
claimed AS (SELECT collection_timestamp, unnest(['click', 'error', 'purchase', 'signup', 'view']) AS data_type FROM runs)
SELECT * FROM claimed c WHERE NOT EXISTS (SELECT 1 FROM events e
  WHERE strftime(date_trunc('hour', e.ts), '%Y%m%d_%H%M%S') = c.collection_timestamp AND e.event_type = c.data_type)""")
def q10(spark, sf):
    """Every hourly run claims all types; the events tell what it really landed."""
    from macrotide.functions import format_snapshot

    files = table(spark, sf, "events").select(
        format_snapshot(F.date_trunc("hour", "ts")).alias("collection_timestamp"), F.col("event_type").alias("data_type")
    ).distinct()
    claims = F.array(*[F.lit(t) for t in ("click", "error", "purchase", "signup", "view")])
    log = files.select("collection_timestamp").distinct().withColumn("data_types_collected", claims)
    return q.run_completeness(log, files)


# All checks of a table in one pass, and the gate --------------------------------------

def _order_rules(spark, sf):
    solvent = table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    return [
        *gate.not_null("o_orderkey", "o_totalprice"), gate.in_range("o_totalprice", 1000.0, 400000.0),
        gate.accepted("o_orderstatus", ["F", "O"]), gate.fresh("o_orderdate", "1998-09-01 00:00:00", 24), gate.at_least(1),
        gate.breaks("day and total", (F.dayofmonth("o_orderdate") == 31) & (F.col("o_totalprice") > 100000)),
        gate.Unique("one order a customer and day", ["o_custkey", "o_orderdate"]),
        gate.HasParent("customer is solvent", "o_custkey", solvent, "c_custkey"),
    ]


_ORDER_VERDICTS = """
WITH counted(name, n) AS (
  SELECT 'o_orderkey is set', count(*) FILTER (o_orderkey IS NULL) FROM orders
  UNION ALL SELECT 'o_totalprice is set', count(*) FILTER (o_totalprice IS NULL) FROM orders
  UNION ALL SELECT 'o_totalprice in range', count(*) FILTER (o_totalprice < 1000 OR o_totalprice > 400000) FROM orders
  UNION ALL SELECT 'o_orderstatus accepted', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders
  UNION ALL SELECT 'o_orderdate fresh', CAST(epoch(TIMESTAMP '1998-09-01' - max(o_orderdate)) > 86400 AS BIGINT) FROM orders
  UNION ALL SELECT 'at least 1 rows', greatest(1 - count(*), 0) FROM orders
  UNION ALL SELECT 'day and total', count(*) FILTER (day(o_orderdate) = 31 AND o_totalprice > 100000) FROM orders{more})
SELECT name AS "check", n AS n_failing, n = 0 AS passed FROM counted"""


@query("q_all_checks_in_one_pass", _ORDER_VERDICTS.format(more=""))
def q_one_pass(spark, sf):
    return gate.check_all(table(spark, sf, "orders"), [r for r in _order_rules(spark, sf) if isinstance(r, gate.Rule)])


@query("q_gate_verdicts", _ORDER_VERDICTS.format(more="""
  UNION ALL SELECT 'one order a customer and day', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)
  UNION ALL SELECT 'customer is solvent', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"""))
def q_gate(spark, sf):
    """What stopped a write: counted by the tasks that staged the rows, and on the staged keys."""
    try:
        counts = gate.write_checked(table(spark, sf, "orders"), scratch_dir(spark, "gated"), _order_rules(spark, sf), "o_orderpriority")
    except gate.ChecksFailed as stopped:
        counts = stopped.counts
    return gate.verdicts(spark, counts)


@query("k3_gated_table", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def k3_gated(spark, sf):
    """Good orders pass the gate; a second version that breaks a rule in some rows leaves the table as it was."""
    path, orders = scratch_dir(spark, "gated"), table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    rules = [gate.Unique("one row an order", "o_orderkey"), gate.in_range("o_totalprice", 0.0)]
    gate.write_checked(orders, path, rules, "o_orderstatus")
    worse = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")))
    with contextlib.suppress(gate.ChecksFailed):
        gate.write_checked(worse, path, rules, "o_orderstatus")
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice")
