"""Laws that results must obey, and brute force on small tables."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from macrotide import functions as M
from macrotide.operators import clean, joins, network, ordering, prefix, quality, series as s, stats
from macrotide.plans import layers
from tests.conftest import SF_DIR, rows
from workload import standins as st

DAY0 = date(2020, 1, 1)


def day(n):
    return DAY0 + timedelta(days=n)


def test_matrix_is_symmetric_with_unit_diagonal(spark):
    cols = ["price_usd", *st.INDICATORS]
    found = {(r.x, r.y): r for r in stats.correlation_matrix(st.facts(spark, SF_DIR), cols).collect()}
    assert len(found) == len(cols) ** 2
    for (x, y), r in found.items():
        assert r.r == found[y, x].r and r.n == found[y, x].n
        assert r.r2 == pytest.approx(r.r * r.r)
        assert x != y or r.r == pytest.approx(1.0)


def test_correlation_with_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, None)], "x double, y double")
    assert rows(stats.correlate(df, "x", "y")) == [(None, None, 2)]


def test_returns_matrix_needs_a_key(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        stats.correlation_matrix(df, ["x"], on="returns")
    with pytest.raises(ValueError):
        stats.correlation_matrix(df, ["x"], on="other")


def test_conditional_maximum_equals_pivot(spark):
    points = st.series(spark, SF_DIR)
    pivoted = points.groupBy("date").pivot("series_key", st.INDICATORS).agg(F.max("numeric_value"))
    assert rows(stats.pivot_series(points, st.INDICATORS)) == rows(pivoted)


def test_fill_is_idempotent_and_two_passes_equal_one(spark):
    dense = joins.densify(st.series(spark, SF_DIR).drop("n_rows"), "series_key")
    once = s.forward_fill(dense, "series_key", "numeric_value")
    assert rows(s.forward_fill(once, "series_key", "numeric_value")) == rows(once)
    for pieces in (1, 3, 40):
        assert rows(s.forward_fill_blocks(dense, "series_key", "numeric_value", pieces=pieces)) == rows(once)


def test_drawdown_two_passes_equal_one(spark):
    prices = st.prices(spark, SF_DIR).select("asset_id", "date", "price_usd")
    once = rows(s.drawdown(prices, "asset_id"))
    assert rows(s.drawdown_blocks(prices, "asset_id", pieces=11)) == once
    assert max(r[-1] for r in once) <= 0


def test_wide_fill_equals_tall_fill(spark):
    points = st.series(spark, SF_DIR)
    tall = layers.economic_wide(points, st.INDICATORS)
    given = layers.economic_wide(points, st.INDICATORS, st.last_day(spark, SF_DIR))
    sparse = stats.pivot_series(points, st.INDICATORS)
    days = tall.select("date").join(sparse, "date", "left")
    wide = s.forward_fill_blocks(days, None, st.INDICATORS)
    assert rows(tall) == rows(wide.select(*tall.columns)) == rows(given)


def test_histogram_counts_every_row(spark):
    returned = st.returns(spark, SF_DIR)
    total = returned.filter("daily_return is not null").count()
    assert stats.histogram(returned, "daily_return", -0.5, 0.5, 7).agg(F.sum("n")).first()[0] == total


def test_zero_and_negative_prices_give_no_return(spark):
    df = spark.createDataFrame(
        [("a", day(0), 0.0), ("a", day(1), 5.0), ("a", day(2), -1.0), ("a", day(3), 2.0), ("a", day(4), 3.0), ("b", day(0), 1.0)],
        "k string, date date, price_usd double")
    assert [r.daily_return for r in s.daily_return(df, "k").orderBy("k", "date").collect()] == [None, None, -1.2, None, 0.5, None]


def test_short_series_have_no_volatility(spark):
    df = spark.createDataFrame([("a", day(i), float(i)) for i in range(5)], "k string, date date, daily_return double")
    found = s.rolling_volatility(df, "k", 3).orderBy("date").collect()
    assert [r.volatility for r in found] == [None, None, 1.0, 1.0, 1.0]


def test_crossover_signals(spark):
    path = [5.0, 4.0, 3.0, 4.0, 6.0, 8.0, 7.0, 3.0, 1.0]
    df = spark.createDataFrame([("a", day(i), p) for i, p in enumerate(path)], "k string, date date, price_usd double")
    found = s.trend_signal(df, "k", 1, 3).orderBy("date").collect()
    assert [r.signal for r in found if r.signal] == ["buy", "sell"]


def test_densify_widens_and_keeps_rows_of_one_day(spark):
    df = spark.createDataFrame([("a", day(2), 1), ("a", day(4), 2), ("a", day(4), 3)], "k string, date date, v int")
    assert rows(joins.densify(df, "k")) == [("a", day(2), 1), ("a", day(3), None), ("a", day(4), 2), ("a", day(4), 3)]
    wide = joins.densify(df.limit(1), "k", start=day(1), end=day(4))
    assert wide.count() == 4 and wide.filter("v is not null").count() == 1


def test_missing_dates_brute_force(spark):
    rng = random.Random(3)
    present = {(k, n) for k in "abcd" for n in range(-10, 30) if rng.random() < 0.5} | {("early", -5), ("late", 99)}
    df = spark.createDataFrame([(k, day(n)) for k, n in present for _ in range(2)], "k string, date date")
    expected = {(k, day(n)) for k in [*"abcd", "early", "late"] for n in range(0, 21) if (k, n) not in present}
    found = [tuple(r) for r in joins.missing_dates(df, "k", day(0), day(20)).collect()]
    assert len(found) == len(set(found)) and set(found) == expected


@pytest.mark.parametrize("pieces", [1, 2, 9, 60])
def test_asof_join_brute_force(spark, pieces):
    """One key holds most rows; some left rows lie before every right row, some keys
    have no right rows, and times coincide."""
    rng = random.Random(5)
    t0 = datetime(2024, 1, 1)

    def made(n, with_none):
        picks = ["hot"] * 6 + ["b", "c"] + (["left_only"] if with_none else ["right_only"])
        return [(rng.choice(picks), t0 + timedelta(minutes=rng.randrange(3000)), i) for i in range(n)]

    left, right = made(300, True), [r for r in {(k, t): (k, t, i) for k, t, i in made(200, False)}.values()]
    right = [(k, t, None if v % 9 == 0 else v) for k, t, v in right]
    out = joins.asof_join(
        spark.createDataFrame(left, "k string, ts timestamp_ntz, id int"),
        spark.createDataFrame(right, "k string, at timestamp_ntz, v int"), "k", "ts", ["v", "at"], right_ts="at",
        pieces=pieces)
    expected = []
    for k, t, i in left:
        before = [(a, v) for kk, a, v in right if kk == k and a <= t]
        at, v = max(before, key=lambda p: p[0]) if before else (None, None)
        expected.append((k, t, i, v, at))
    assert sorted(map(repr, (tuple(r) for r in out.collect()))) == sorted(map(repr, expected))


@pytest.mark.parametrize("pieces", [1, 5])
def test_asof_join_matches_no_null(spark, pieces):
    t = datetime(2024, 1, 1)
    left = spark.createDataFrame([("a", t, 1), ("a", None, 2), (None, t, 3)], "k string, ts timestamp_ntz, id int")
    right = spark.createDataFrame([("a", None, 7), (None, t, 8), ("b", t, 9)], "k string, ts timestamp_ntz, v int")
    out = joins.asof_join(left, right, "k", "ts", ["v"], pieces=pieces)
    assert sorted((r.id, r.v) for r in out.collect()) == [(1, None), (2, None), (3, None)]


def test_asof_join_without_other_left_columns(spark):
    left = spark.createDataFrame([("a", datetime(2024, 1, 2))], "k string, ts timestamp_ntz")
    right = spark.createDataFrame([("a", datetime(2024, 1, 1), 5)], "k string, ts timestamp_ntz, v int")
    assert rows(joins.asof_join(left, right, "k", "ts", ["v"])) == [("a", datetime(2024, 1, 2), 5)]


@pytest.mark.parametrize("text", [False, True])
def test_latest_version_keeps_rows_whole(spark, text):
    """Ties and null versions included; each picked row must be one of the rows."""
    rng = random.Random(7)
    made = [("hot" if rng.random() < 0.7 else f"k{i % 5}", rng.choice([None, 1, 2, 3]), i, float(i)) for i in range(400)]
    made.append(("only_null", None, 5, None))
    df = spark.createDataFrame(made, "k string, version int, a bigint, b double").repartition(6)
    if text:
        df = df.withColumn("t", F.col("a").cast("string"))
    found = clean.latest_version(df, "k", "version").collect()
    assert len(found) == len({r[0] for r in made})
    for r in found:
        newest = max((m[1] or 0) for m in made if m[0] == r.k)
        assert (r.version or 0) == newest
        assert (r.k, r.version, r.a, r.b) in made


def test_bars_take_the_last_row_by_time_then_id(spark):
    t = datetime(2024, 1, 1, 12)
    data = [("a", t, 1, 10.0), ("a", t, 2, 20.0), ("a", t - timedelta(hours=1), 9, 30.0), ("a", t, 0, None)]
    for kind in ("int", "bigint", "string"):
        df = spark.createDataFrame(data, "k string, ts timestamp_ntz, id bigint, v double").withColumn("id", F.col("id").cast(kind))
        assert rows(s.daily_bars(df, "k", "ts", "v", "id")) == [("a", date(2024, 1, 1), 20.0, 60.0, 3)]


def test_bars_of_dated_rows_take_the_largest_id(spark):
    df = spark.createDataFrame([("a", day(0), -5, 1.0), ("a", day(0), -9, 2.0)], "k string, d date, id bigint, v double")
    assert rows(s.daily_bars(df, "k", "d", "v", "id")) == [("a", day(0), 1.0, 3.0, 2)]


def test_outliers_of_named_and_nameless_keys(spark):
    data = [(k, float(i % 3)) for i in range(100) for k in ("a", None)] + [("a", 50.0), (None, 500.0), ("b", 1.0), ("b", 1.0), ("c", 7.0)]
    df = spark.createDataFrame(data, "k string, v double")
    assert [r[:2] for r in rows(quality.check_outliers(df, "k", "v"))] == [(None, 500.0), ("a", 50.0)]


def test_freshness_is_judged_to_the_second(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1, 11, 0, 1)), ("b", datetime(2024, 1, 1, 12)), ("c", datetime(2024, 1, 1, 11, 59, 59))], "k string, ts timestamp_ntz")
    found = quality.check_freshness(df, "k", "ts", "2024-01-02 00:00:00", 12)
    assert rows(found.select("k", "age_hours", "is_stale")) == [("a", 12, True), ("b", 12, False), ("c", 12, True)]


def test_small_amounts_are_not_rounded_away(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1, h), v) for h, v in ((1, 0.00002), (2, 0.00003))], "k string, ts timestamp_ntz, v double")
    assert abs(s.daily_bars(df, "k", "ts", "v").first().volume_usd - 0.00005) < 1e-15
    fees = df.selectExpr("ts AS snapshot_ts", "1 AS target", "1.004e0 AS fee_rate")
    assert network.fee_history(fees).first().fee_avg == 1.004


def test_rows_without_a_date_are_versions_of_nothing(spark):
    data = [("a", None, 1), ("a", None, 2), ("a", day(0), 1), ("a", day(0), 3)]
    df = spark.createDataFrame(data, "k string, date date, run int")
    assert rows(clean.latest_version(df, ["k", "date"], "run", apart="date")) == [("a", None, 1), ("a", None, 2), ("a", day(0), 3)]


def test_densify_keeps_rows_without_a_date(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", day(0), 2.0), ("a", day(2), 3.0)], "k string, date date, v double")
    assert rows(joins.densify(df, "k")) == [("a", None, 1.0), ("a", day(0), 2.0), ("a", day(1), None), ("a", day(2), 3.0)]


def test_a_pivot_takes_any_key(spark):
    df = spark.createDataFrame([(day(0), "it's", 1.0), (day(0), "a`b", 2.0)], "date date, series_key string, numeric_value double")
    assert rows(stats.pivot_series(df, ["it's", "a`b"])) == [(day(0), 1.0, 2.0)]


def test_of_two_blocks_of_one_height_the_later_stands(spark):
    df = spark.createDataFrame([("x", 7, datetime(2024, 1, 1)), ("y", 7, datetime(2024, 1, 2)), ("z", 6, datetime(2024, 1, 3))], "id string, height bigint, block_ts timestamp_ntz")
    assert network.latest_block(df).first().id == "y"


def test_a_burst_is_cut_and_rows_without_a_time_pass_by(spark):
    """99 % of a key's rows fall within one second, and as many have no time at all."""
    second = F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.when(F.col("id") % 100 == 0, F.col("id") * 10_000_000).otherwise(F.pmod(F.xxhash64("id"), F.lit(1_000_000))))
    rows_ = spark.range(40_000).select(F.lit("k").alias("k"), second.cast("timestamp_ntz").alias("ts"), "id")
    sizes = [r["count"] for r in prefix._dealt(rows_, ["k"], ["ts"], 20).groupBy("_piece").count().collect()]
    assert max(sizes) <= 4000 and sum(sizes) == 40_000
    nowhere = spark.range(1000).select(F.lit("k").alias("k"), F.lit(None).cast("timestamp_ntz").alias("ts"), (-F.col("id") - 1).alias("id"))
    left = rows_.filter("id % 2 = 0").unionByName(nowhere)
    right = rows_.filter("id % 2 = 1").withColumnRenamed("id", "quote")
    cut_up = joins.asof_join(left, right, "k", "ts", ["quote"], pieces=20)
    whole = joins.asof_join(left, right, "k", "ts", ["quote"], pieces=1)
    assert rows(cut_up.select("id", "ts")) == rows(whole.select("id", "ts"))
    # Of several quotes at one instant any may be found, so quotes are compared by their times.
    at = right.select("quote", F.col("ts").alias("at"))
    times = [rows(found.join(at, "quote", "left").select("id", "at")) for found in (cut_up, whole)]
    assert times[0] == times[1]
    assert cut_up.filter("ts IS NULL AND quote IS NOT NULL").count() == 0


def test_next_pages_follow_from_the_last_row(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(25)], "id int, v int")
    seen, last = [], None
    while True:
        page = ordering.page(df, "v", 7, 0, "desc", "id") if last is None else ordering.page_after(df, "v", last.v, 7, "desc", "id", last.id)
        found = page.collect()
        if not found:
            break
        seen += [r.id for r in found]
        last = found[-1]
    assert seen == [r.id for r in ordering.page(df, "v", 100, 0, "desc", "id").collect()]


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1, 5), (2, None), (3, 6)], "id int, fk int")
    parent = spark.createDataFrame([(5,), (5,)], "pk int")
    assert rows(joins.orphans(child, parent, "fk", "pk")) == [(3, 6)]


def test_pages_cover_the_table_once(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(25)], "id int, v int")
    pages = [rows(ordering.page(df, "v", 10, offset, "desc", tie="id")) for offset in (0, 10, 20)]
    assert sorted(r for p in pages for r in p) == rows(df) or len({r for p in pages for r in p}) == 25
    with pytest.raises(ValueError):
        ordering.sort_series(df, "v", "sideways")


def test_date_filters_are_inclusive(spark):
    df = spark.createDataFrame([(day(i), datetime(2020, 1, 1 + i, 23, 59)) for i in range(10)], "date date, ts timestamp_ntz")
    assert clean.filter_dates(df, day(2), day(4)).count() == 3
    assert clean.filter_dates(df, day(2), day(4), "ts").count() == 3
    assert clean.filter_dates(df, None, None).count() == 10
    assert clean.trailing_days(df, day(9), 3).count() == 4


def test_helpers_on_bad_text(spark):
    df = spark.createDataFrame([("1.5",), ("N/A",), ("NaN",), ("-inf",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(M.safe_double("t")).collect()] == [1.5, None, None, None, None, None]
    bad = df.select(M.parse_day("t"), M.parse_iso("t"), M.parse_snapshot("t"), M.safe_long("t"))
    assert all(v is None for r in bad.collect()[1:] for v in r)
    assert spark.range(1).select(M.safe_div(F.lit(1.0), F.lit(0.0))).first()[0] is None


def test_quality_verdict(spark):
    df = spark.createDataFrame([(1, None), (1, 2)], "id int, v int")
    assert rows(quality.verdict(quality.check_unique(df, "id"), "id is unique")) == [("id is unique", 1, False)]
    assert rows(quality.verdict(quality.check_not_null(df, "id"), "id is set")) == [("id is set", 0, True)]


def test_network_state_takes_each_sources_newest(spark):
    a = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 3))], "n int, at timestamp_ntz")
    b = spark.createDataFrame([("x", datetime(2024, 1, 2)), ("y", datetime(2023, 1, 1))], "s string, t timestamp_ntz")
    row = joins.network_stats({"a": (a, "at"), "b": (b, "t")}).first()
    assert (row.a.n, row.b.s) == (2, "x")


def test_zoneless_times_ignore_the_session_zone(spark):
    """02:30 does not exist on that day in the session's zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("20240310_023000", 1710037800)], "stamp string, unix bigint")
        got = df.select(M.parse_snapshot("stamp").alias("a"), M.from_epoch("unix").alias("b"))
        gap = got.select("a", "b", M.seconds_between("a", "b").cast("int"), M.seconds_between(F.date_sub("a", 1).cast("timestamp_ntz"), "a").cast("int"))
        at = datetime(2024, 3, 10, 2, 30)
        assert [tuple(r) for r in gap.collect()] == [(at, at, 0, 86400 + 9000)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_day_that_the_economic_table_has_twice_is_an_error(spark):
    prices = spark.createDataFrame([("a", date(2024, 1, 1), 1.0), ("a", None, 2.0)], "asset_id string, date date, price_usd double")
    wide = spark.createDataFrame([(date(2024, 1, 1), 5.0), (None, 1.0), (None, 2.0)], "date date, rate double")
    assert rows(joins.fact_prices(prices, wide).select("asset_id", "price_usd", "rate")) == [("a", 1.0, 5.0), ("a", 2.0, None)]
    with pytest.raises(Exception, match="several rows of one day"):
        joins.fact_prices(prices, wide.union(wide)).collect()
