"""Operators against brute force, invariants, and the plans that make them scale."""

from __future__ import annotations

import datetime
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adloom.functions import text
from adloom.operators import allocation, lifetimes, rollup
from adloom.operators.hierarchy import attach_parents, resolve_ads
from adloom.operators.latest import latest_version, newest_attributes
from adloom.plans import search, social
from tests.conftest import plan, rows

D = datetime.date


@pytest.fixture(scope="module")
def report(spark):
    rng = random.Random(7)
    data = []
    for ad in range(40):
        adset, campaign, account = ad // 4, ad // 12, ad // 24
        for day in range(1, 11):
            if rng.random() < 0.7:
                data.append(
                    (D(2026, 1, day), ad, adset, campaign, account, Decimal(rng.randint(0, 99999)) / 100, rng.randint(0, 900), rng.randint(0, 90))
                )
    schema = "date_start date, ad_id int, adset_id int, campaign_id int, account_id int, spend decimal(18,2), impressions int, clicks int"
    return spark.createDataFrame(data, schema), data


# --- latest version ---


def test_latest_version_against_brute_force(spark):
    rng = random.Random(1)
    data = [(rng.randint(0, 30), rng.randint(0, 5) if rng.random() < 0.9 else None, rng.randint(0, 9)) for _ in range(500)]
    best = {}
    for k, v, x in data:
        rank = (-1 if v is None else v, x)
        best[k] = max(best.get(k, rank), rank)
    got = latest_version(spark.createDataFrame(data, "k int, v int, x int"), ["k"], "v")
    assert {(r.k, -1 if r.v is None else r.v, r.x) for r in got.collect()} == {(k, *r) for k, r in best.items()}


def test_latest_version_does_not_depend_on_row_order(spark):
    data = [(1, 5, "a"), (1, 5, "c"), (1, 5, "b"), (None, 1, "x"), (None, 2, "w")]
    for order in (data, data[::-1]):
        got = latest_version(spark.createDataFrame(order, "k int, v int, x string"), ["k"], "v")
        assert rows(got) == [(None, 2, "w"), (1, 5, "c")]


def test_latest_version_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    text_plan = plan(latest_version(df, ["k"], "v"))
    partial, exchange = text_plan.rindex("Partial"), text_plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text_plan and partial > exchange


def test_one_key_with_a_third_of_all_rows(spark):
    df = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    got = latest_version(df, ["k"], "v")
    assert got.count() == df.select("k").distinct().count()
    assert got.filter("k = 0").first().v == 89_997


def test_newest_attributes_aggregates_before_ranking(spark):
    data = [("a", "old", D(2026, 1, 1), 1), ("a", "new", D(2026, 1, 3), 1), ("a", "mid", D(2026, 1, 2), 9), ("b", "x", D(2026, 1, 1), 1)]
    df = spark.createDataFrame(data, "k string, name string, day date, seen int")
    got = newest_attributes(df, "k", ["name"], ["day", "seen"])
    assert rows(got.select("k", "name")) == [("a", "new"), ("b", "x")]
    executed = plan(got)
    assert executed.rindex("HashAggregate") > executed.rindex("WindowGroupLimit")
    assert "SortAggregate" not in executed


def test_newest_attributes_compares_versions_as_one_tuple(spark):
    """The newest of each version column may come from different rows: such a version never existed."""
    data = [("k", "A", 10, 1), ("k", "A", 3, 9), ("k", "B", 10, 5), (None, "n", 1, None), (None, "m", None, 7)]
    df = spark.createDataFrame(data, "k string, name string, day int, seen int")
    got = newest_attributes(df, "k", ["name"], ["day", "seen"])
    assert rows(got) == [(None, "n", 1, None), ("k", "B", 10, 5)]
    three = df.withColumn("third", F.col("seen") * 0 + 1)
    assert rows(newest_attributes(three.where("k = 'k'"), "k", ["name"], ["day", "seen", "third"])) == [("k", "B", 10, 5, 1)]
    assert newest_attributes(df.limit(0), "k", ["name"], ["day", "seen"]).count() == 0


# --- joins ---


def test_hierarchy(spark):
    ads = spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, 99)], "ad_id int, adset_id int")
    sets = spark.createDataFrame([(10, 100), (11, 101)], "adset_id int, campaign_id int")
    campaigns = spark.createDataFrame([(100, "x", 7), (101, "y", 7)], "campaign_id int, campaign_name string, account_id int")
    accounts = spark.createDataFrame([(7, "acc")], "account_id int, account_name string")
    got = resolve_ads(ads, sets, campaigns, accounts).select("ad_id", "campaign_name", "account_name")
    assert rows(got) == [(1, "x", "acc"), (2, "x", "acc"), (3, "y", "acc")]


@pytest.fixture
def eager_skew(spark):
    """Thresholds under which the skew handling of AQE shows on test-sized data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def hot_facts(spark):
    """A third of all rows on one ad."""
    return spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 5000).alias("ad_id"), F.col("id").alias("spend")
    )


def test_hot_ad_is_split_in_the_parent_join(spark, eager_skew, hot_facts):
    parents = spark.range(5000).select(F.col("id").alias("ad_id"), (F.col("id") % 10).alias("campaign"))
    got = attach_parents(hot_facts, parents).groupBy("campaign").agg(F.sum("spend").alias("spend"), F.count("*").alias("n"))
    assert sum(r.n for r in got.collect()) == 300_000
    assert "skew=true" in plan(got)


def test_hot_group_is_split_when_shares_are_normalised(spark, eager_skew, hot_facts):
    got = allocation.normalise(hot_facts, ["ad_id"], "spend").agg(F.sum("share").alias("s"), F.count("*").alias("n"))
    row = got.collect()[0]
    assert row.n == 300_000 and round(row.s, 6) == hot_facts.select("ad_id").distinct().count()
    assert "skew=true" in plan(got)


# --- days ---


def test_active_days_against_brute_force(spark):
    data = [(1, D(2026, 1, 1), D(2026, 1, 5), D(2026, 1, 3), D(2026, 2, 1)), (2, D(2026, 1, 9), D(2026, 1, 5), D(2026, 1, 1), D(2026, 2, 1)), (3, D(2026, 1, 1), D(2026, 1, 1), D(2026, 1, 1), D(2026, 1, 1))]
    df = spark.createDataFrame(data, "id int, s date, e date, s2 date, e2 date")
    got = lifetimes.active_days(df, [(F.col("s"), F.col("e")), (F.col("s2"), F.col("e2"))]).select("id", "date_start")
    expected = []
    for key, s, e, s2, e2 in data:
        day = D(2026, 1, 1)
        while day <= D(2026, 2, 28):
            if s <= day <= e and s2 <= day <= e2:
                expected.append((key, day))
            day += datetime.timedelta(days=1)
    assert rows(got) == expected
    assert "Join" not in plan(got) and "Exchange" not in plan(got)


@pytest.mark.parametrize("start, end, days", [("2026-01-01", "2026-01-07", 7), ("2026-05-01", "2026-05-01", 1)])
def test_day_spine(spark, start, end, days):
    df = spark.sql(f"SELECT * FROM VALUES (date'{start}'), (date'{end}') AS t(date_start)")
    got = [r.date for r in lifetimes.day_spine(df).orderBy("date").collect()]
    assert len(got) == days and str(got[0]) == start and str(got[-1]) == end


def test_day_spine_of_nothing(spark):
    assert lifetimes.day_spine(spark.createDataFrame([], "date_start date")).isEmpty()


def test_last_days_keeps_both_ends(spark, report):
    df, _ = report
    got = {r.date_start for r in lifetimes.last_days(df, 3).collect()}
    assert got == {D(2026, 1, day) for day in (7, 8, 9, 10)}


def test_between_days(spark, report):
    df, data = report
    got = lifetimes.between_days(df, D(2026, 1, 2), "2026-01-03").count()
    assert got == sum(D(2026, 1, 2) <= r[0] <= D(2026, 1, 3) for r in data)


def test_years(spark):
    df = spark.sql("SELECT * FROM VALUES (date'2024-05-01'), (date'2026-01-01'), (date'2024-07-01') AS t(date_start)")
    years = lifetimes.distinct_years(df)
    assert [r.year for r in years.collect()] == [2024, 2026]
    both = lifetimes.years_with_previous(df)
    assert [r.year for r in both.collect()] == [2023, 2024, 2025, 2026]
    assert both._jdf.queryExecution().sparkPlan().toString().count("Sort ") == 1


# --- roll-ups ---


def test_daily_levels_agree_with_brute_force(spark, report):
    df, data = report
    expected = defaultdict(lambda: [Decimal(0), 0, 0])
    for day, _, adset, campaign, account, spend, impressions, clicks in data:
        for level, key in (("adset", adset), ("campaign", campaign), ("account", account)):
            total = expected[(day, level, key)]
            total[0] += spend
            total[1] += impressions
            total[2] += clicks
    got = {(r.date_start, r.level, r.id): [r.spend, r.impressions, r.clicks] for r in rollup.daily_levels(df).collect()}
    assert got == dict(expected)


def test_levels_have_equal_totals(spark, report):
    df, _ = report
    totals = rollup.daily_levels(df).groupBy("level").agg(F.sum("spend").alias("s")).collect()
    assert len(totals) == 3 and len({r.s for r in totals}) == 1


def test_single_level_equals_grouping_sets(spark, report):
    df, _ = report
    one = rollup.daily_level(df, "campaign").select("date_start", F.col("campaign_id").alias("id"), "spend")
    assert rows(one) == rows(rollup.daily_levels(df).filter("level = 'campaign'").select("date_start", "id", "spend"))


def test_missing_metric_counts_as_zero(spark):
    df = spark.createDataFrame([(D(2026, 1, 1), 1, None, 200), (D(2026, 1, 1), 1, 50, None)], "date_start date, ad_id int, impressions int, clicks int")
    assert rows(rollup.daily_level(df, "ad")) == [(D(2026, 1, 1), 1, 50, 200)]


def test_lifetime_totals(spark, report):
    df, data = report
    lives = spark.createDataFrame([(0, D(2025, 12, 1), D(2026, 3, 1))], "ad_id int, start_date date, end_date date")
    got = {r.ad_id: r for r in rollup.lifetime_totals(df, "ad", lives).collect()}
    assert (got[0].date_start, got[0].date_stop) == (D(2025, 12, 1), D(2026, 3, 1))
    assert got[0].clicks == sum(r[7] for r in data if r[1] == 0)
    days = [r[0] for r in data if r[1] == 5]
    assert (got[5].date_start, got[5].date_stop) == (min(days), max(days))
    bounds = (F.lit("2026-01-01").cast("date"), F.lit("2026-01-31").cast("date"))
    whole = rollup.lifetime_totals(df, "campaign", bounds=bounds).collect()
    assert {(r.date_start, r.date_stop) for r in whole} == {(D(2026, 1, 1), D(2026, 1, 31))}
    assert sum(r.clicks for r in whole) == sum(r[7] for r in data)


def test_lifetime_levels_equal_single_levels_in_one_pass(spark, report):
    df, data = report
    parents = df.select("ad_id", "adset_id", "campaign_id").distinct()
    lives = {"ad": spark.createDataFrame([(0, D(2025, 12, 1), D(2026, 3, 1))], "ad_id int, start_date date, end_date date")}
    bounds = (F.lit("2026-01-01").cast("date"), F.lit("2026-01-31").cast("date"))
    metrics = ["spend", "clicks"]
    totals = rollup.ad_lifetime_totals(df.select("ad_id", "date_start", *metrics), metrics)
    got = rollup.lifetime_levels(totals, parents, lives, bounds, metrics)
    ads = rollup.lifetime_totals(df, "ad", lives["ad"], metrics=metrics)
    sets = rollup.lifetime_totals(df, "adset", bounds=bounds, metrics=metrics)
    assert rows(got.filter("level = 'ad'").drop("level")) == rows(ads)
    assert rows(got.filter("level = 'adset'").drop("level")) == rows(sets)
    assert {r.level: r.n for r in got.groupBy("level").agg(F.sum("clicks").alias("n")).collect()} == dict.fromkeys(
        ("ad", "adset", "campaign"), sum(r[7] for r in data)
    )


def test_levels_of_ids_of_different_types(spark):
    df = spark.createDataFrame([("s", 1, 2, 3)], "adset_id string, campaign_id int, account_id bigint, clicks int")
    levels = {"adset": "adset_id", "campaign": "campaign_id", "account": "account_id"}
    got = rollup.by_level(df, levels, [], rollup.sums(["clicks"]))
    assert rows(got) == [("account", "2", 3), ("adset", "s", 3), ("campaign", "1", 3)]


def test_search_totals_recompute_the_ratio(spark):
    data = [("c", "100", 10, "1.5", 3), ("c", "bad", 20, "2", 4), ("d", "0", 5, None, 1)]
    df = spark.createDataFrame(data, "campaign_id string, impressions string, clicks int, cost string, all_conversions int")
    got = {r.campaign_id: r for r in rollup.search_totals(df, ["campaign_id"]).collect()}
    assert (got["c"].impressions, got["c"].clicks, got["c"].cost, got["c"].ctr_fraction) == (100.0, 30, 3.5, 0.3)
    assert got["d"].ctr_fraction == 0.0


def test_budget_remaining(spark):
    df = spark.createDataFrame(
        [(D(2026, 1, 1), 1, Decimal("100.00"), Decimal("30.25")), (D(2026, 1, 1), 1, Decimal("100.00"), Decimal("80.00"))],
        "date_start date, adset_id int, daily_budget decimal(18,2), spend decimal(18,2)",
    )
    assert rollup.budget_remaining(df).first().budget_remaining == Decimal("-10.25")


# --- breakdowns ---


def brute_allocate(total, weights, den, money):
    parts = []
    for w in weights[:-1]:
        exact = total * w / den
        parts.append(round(exact) if money else int(exact // 1))
    return [*parts, total - sum(parts)]


def test_allocation_conserves_totals(spark, report):
    df, data = report
    named = df.withColumn("adset_name", F.when(F.col("adset_id") % 2 == 0, "Phụ nữ CEO").otherwise("Broad"))
    got = social.demographic_rows(named)
    assert got.count() == 12 * len(data)
    totals = got.groupBy("ad_id", "date_start").agg(F.sum("spend").alias("spend"), F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"))
    assert rows(totals.select("ad_id", "date_start", "spend", "impressions", "clicks")) == sorted(
        (r[1], r[0], r[5], r[6], r[7]) for r in data
    )
    assert "Exchange" not in plan(got)


def test_allocation_against_brute_force(spark):
    weights = [3, 1, 2, 7]
    totals = [0, 1, 5, 13, 999, 123457]
    df = spark.createDataFrame([(n, Decimal(n) / 100) for n in totals], "n long, m decimal(18,2)").withColumn("id", F.col("n"))
    cells = [{"cell": i} for i in range(4)]
    got = allocation.allocate(df, ["n", "m"], cells, [F.lit(w) for w in weights])
    for total in totals:
        mine = sorted((r.cell, r.n, r.m) for r in got.filter(F.col("id") == total).collect())
        assert [r[1] for r in mine] == brute_allocate(total, weights, 13, False)
        assert [int(r[2] * 100) for r in mine] == brute_allocate(total, weights, 13, True)


def test_oversized_shares_leave_a_negative_remainder(spark):
    df = spark.createDataFrame([(1, 100)], "id int, n long")
    got = allocation.allocate(df, ["n"], [{"c": 0}, {"c": 1}, {"c": 2}], [F.lit(1500)] * 3, F.lit(2000))
    assert [r.n for r in got.orderBy("c").collect()] == [75, 75, -50]


def test_item_lists_may_differ_in_length(spark):
    data = [(1, 10, ["a", "b", "c"], [1.0, 1.0, 1.0]), (2, 7, ["a"], [5.0]), (3, 9, [], []), (4, 8, None, None)]
    df = spark.createDataFrame(data, "id int, n long, item array<string>, w array<double>")
    got = allocation.allocate_items(df, ["n"], "item", "w")
    assert rows(got) == [(1, "a", 3), (1, "b", 3), (1, "c", 4), (2, "a", 7)]


def test_demographic_weights_follow_the_audience(spark):
    parts = text.audience(F.lit("Phụ nữ - CEO"))
    df = spark.range(1).select(*[c.alias(k) for k, c in parts.items()])
    got = df.select(F.array(*allocation.demographic_weights(F.col("gender"), F.col("age_min"), F.col("age_max"))).alias("w")).first().w
    weight = dict(zip([(c["age"], c["gender"]) for c in allocation.DEMOGRAPHIC_CELLS], got))
    assert weight[("35-44", "female")] == 60000 and weight[("35-44", "male")] == 600
    assert weight[("18-24", "female")] == 1000 and weight[("18-24", "male")] == 10
    assert weight[("65+", "female")] == 6000 and weight[("25-34", "male")] == 30
    assert all(w == int(w) for w in got)


def test_normalise(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 0.0), (None, 2.0)], "k string, w double")
    got = allocation.normalise(df, ["k"], "w").select("k", "share")
    assert rows(got) == [(None, 1.0), ("a", 0.25), ("a", 0.75), ("b", 0.0)]


def test_emit_cells_needs_no_join(spark):
    got = allocation.emit_cells(spark.range(5), allocation.DEMOGRAPHIC_CELLS, "cell")
    assert got.count() == 60 and got.select("cell", "age", "gender").distinct().count() == 12
    assert "Join" not in plan(got)


def test_click_types_truncate_without_remainder(spark):
    df = spark.createDataFrame([("c", 1000, 100, 50, Decimal("99.99"))], "campaign_id string, impressions long, clicks long, all_conversions long, cost decimal(18,2)")
    got = search.click_types(df, F.col("campaign_id")).collect()
    assert [r.click_type for r in got] == list(allocation.CLICK_TYPES)
    assert all(0.1 * 1000 <= r.impressions <= 0.3 * 1000 for r in got)
    assert all(r.conversions == int(r.all_conversions * 0.8) for r in got)


def test_breakdown_ratios_have_a_floor(spark):
    df = spark.createDataFrame([("g", 0, 0, 0, Decimal("10.00"))], "g string, impressions long, clicks long, all_conversions long, cost decimal(18,2)")
    got = search.breakdown(df, [{"gender": g} for g in allocation.SEARCH_GENDERS], F.col("g"))
    assert sum(r.cost for r in got.collect()) == Decimal("10.00")
    assert all(r.ctr_fraction == 0 and r.average_cpc == float(r.cost) for r in got.collect())


def test_fractions_and_large_money_are_split_exactly(spark):
    df = spark.sql("select cast('9999999999999999.99' as decimal(18,2)) as m, 3.7D as f, 7 as n, array('a', 'b', 'c') as cell, array(1, 1, 1) as w")
    got = allocation.allocate_items(df, ["m", "f", "n"], "cell", "w").collect()
    assert sum(r.m for r in got) == Decimal("9999999999999999.99")
    assert sum(r.f for r in got) == pytest.approx(3.7) and got[0].f == pytest.approx(3.7 / 3)
    assert [r.n for r in got] == [2, 2, 3]


def test_breakdown_of_lists_in_rows_conserves_totals(spark):
    df = spark.createDataFrame(
        [
            (1, Decimal("9999999999999999.99"), 101, 7, 3.7, [("a", "EXACT")]),
            (2, Decimal("0.05"), 101, 7, 3.7, [("a", "EXACT"), ("b", "BROAD"), ("a", "EXACT")]),
            (3, Decimal("1.00"), 1, 1, 1.0, []),
            (4, None, None, None, None, [("c", "PHRASE"), ("d", None)]),
        ],
        "g int, cost decimal(18,2), impressions bigint, clicks bigint, all_conversions double,"
        " keywords array<struct<keyword: string, match_type: string>>",
    )
    got = search.breakdown_items(df, "keywords", F.col("g").cast("string")).collect()
    assert sorted((r.g, r.keyword, r.match_type or "") for r in got) == [
        (1, "a", "EXACT"), (2, "a", "EXACT"), (2, "a", "EXACT"), (2, "b", "BROAD"), (4, "c", "PHRASE"), (4, "d", "")
    ]
    for g, cost, impressions, conversions in ((1, Decimal("9999999999999999.99"), 101, 3.7), (2, Decimal("0.05"), 101, 3.7), (4, 0, 0, 0)):
        rows_ = [r for r in got if r.g == g]
        assert sum(r.cost for r in rows_) == cost and sum(r.impressions for r in rows_) == impressions
        assert sum(r.all_conversions for r in rows_) == pytest.approx(conversions)
