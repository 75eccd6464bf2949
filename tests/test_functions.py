"""Cleaning, calendar, KPI and text functions on small fixtures."""

from __future__ import annotations

import datetime
import hashlib
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions import calendar, clean, kpi, text
from adloom.functions.aliases import CAMEL, HEADING, canonicalise, spellings
from adloom.sinks.files import landing_path
from tests.conftest import rows

D = datetime.date


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "value, expected",
    [("12", 12), ("12.7", 12), ("-3.9", -3), (" 7 ", 7), ("1e3", 1000), ("n/a", None), ("", None), ("99999999999", None), (None, None)],
)
def test_int_from_text(spark, value, expected):
    assert one(spark, clean.to_int(F.lit(value).cast("string"))) == expected


def test_int_keeps_all_digits_of_integral_source(spark):
    big = 9007199254740993
    assert one(spark, clean.to_int(F.lit(big), T.LongType(), "bigint")) == big


@pytest.mark.parametrize(
    "value, expected",
    [("2025-12-31", D(2025, 12, 31)), ("2025-02-30", None), ("31/12/2025", None), ("2025-1-1", None), ("", None)],
)
def test_day(spark, value, expected):
    assert one(spark, clean.to_day(F.lit(value))) == expected


def test_instant_with_offset(spark):
    assert one(spark, F.unix_seconds(clean.to_instant(F.lit("2025-02-07T10:23:36+0700")))) == 1738898616
    assert one(spark, clean.to_instant(F.lit("yesterday"))) is None


def test_money_is_exact(spark):
    assert str(one(spark, clean.to_money(F.lit("89958")))) == "89958.00"
    assert str(one(spark, clean.to_money(F.lit("0.125")))) == "0.13"
    assert one(spark, clean.to_money(F.lit("free"))) is None


def test_conform_adds_missing_and_converts(spark):
    schema = T.StructType(
        [T.StructField("a", T.IntegerType()), T.StructField("day", T.DateType()), T.StructField("gone", T.DoubleType())]
    )
    df = spark.createDataFrame([("3.0", "2025-01-02", "x")], "a string, day string, extra string")
    out = clean.conform(df, schema)
    assert out.schema.simpleString() == "struct<a:int,day:date,gone:double>"
    assert rows(out) == [(3, D(2025, 1, 2), None)]


def test_spellings_are_unique_without_case():
    for name in {*HEADING, *CAMEL}:
        found = [s.lower() for s in spellings(name)]
        assert len(found) == len(set(found))


def test_three_spellings_become_one_column(spark):
    camel = spark.createDataFrame([("a", 1)], "id string, linkClicks int")
    heading = spark.createDataFrame([("b", 2)], "id string, `Link clicks` int")
    snake = spark.createDataFrame([("c", 3)], "id string, link_clicks int")
    for df in (camel, heading, snake):
        assert sorted(canonicalise(df).columns) == ["id", "link_clicks"]
    mixed = camel.unionByName(heading, allowMissingColumns=True).unionByName(snake, allowMissingColumns=True)
    assert rows(canonicalise(mixed).select("id", "link_clicks")) == [("a", 1), ("b", 2), ("c", 3)]


def test_vietnamese_and_special_headings(spark):
    df = spark.createDataFrame([(1, 2.5, 3)], "`Hoàn tất đăng ký` int, `Chi phí / ThruPlay` double, `Video Views (25%)` int")
    out = canonicalise(df)
    assert out.first().asDict() == {"completed_registration": 1, "cost_per_thru_play": 2.5, "video_views_p25": 3}


def test_require_drops_rows_with_gaps(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("c", None)], "id string, n int")
    assert rows(clean.require(df, "id", "n")) == [("a", 1)]


# --- calendar ---


@pytest.mark.parametrize("day, weekday", [("2026-01-05", 1), ("2026-01-03", 6), ("2026-01-04", 7)])
def test_iso_weekday(spark, day, weekday):
    assert one(spark, calendar.iso_weekday(F.lit(day).cast("date"))) == weekday


@pytest.mark.parametrize(
    "day, name",
    [
        ("2026-01-01", "Tết Dương Lịch"),
        ("2026-01-14", None),
        ("2026-01-15", "Tết Nguyên Đán"),
        ("2026-02-05", "Tết Nguyên Đán"),
        ("2026-02-06", None),
        ("2026-04-30", "Ngày Giải Phóng Miền Nam"),
        ("2026-05-01", "Ngày Quốc Tế Lao Động"),
        ("2026-09-02", "Quốc Khánh"),
    ],
)
def test_holidays(spark, day, name):
    assert one(spark, calendar.holiday_name(F.lit(day).cast("date"))) == name


def test_holidays_are_data(spark):
    rules = ((12, 24, 12, 26, "Christmas"),)
    assert one(spark, calendar.holiday_name(F.lit("2026-12-25").cast("date"), rules)) == "Christmas"


def test_season_factors(spark):
    def social(day):
        return one(spark, calendar.social_season_factor(F.lit(day).cast("date")))

    def search(day):
        return one(spark, calendar.search_season_factor(F.lit(day).cast("date")))

    assert social("2026-01-03") > social("2026-01-05") == 1.0
    assert social("2026-01-20") == 1.8
    assert social("2026-01-23") == pytest.approx(1.4 * 1.8)
    assert search("2026-02-12") == 2.5
    assert search("2026-03-07") == pytest.approx(1.3 * 2.0)
    assert search("2026-01-02") == 1.0


def test_fraction_of_day_and_run_rate(spark):
    noon = F.lit("2026-01-01 12:00:00").cast("timestamp")
    midnight = F.lit("2026-01-01 00:00:00").cast("timestamp")
    assert one(spark, calendar.fraction_of_day(noon)) == 0.5
    assert one(spark, calendar.run_rate(F.lit(10.0), noon)) == 20.0
    assert one(spark, calendar.run_rate(F.lit(10.0), midnight)) is None


def test_days_active_is_never_negative(spark):
    early, late = F.lit("2026-01-01").cast("date"), F.lit("2026-01-11").cast("date")
    assert one(spark, calendar.days_active(early, late)) == 10
    assert one(spark, calendar.days_active(late, early)) == 0


# --- KPIs: two ads of the sample feed, to six digits ---


@pytest.mark.parametrize(
    "spend, impressions, reach, clicks, cpc, cpm, ctr, frequency",
    [
        (89958, 2975, 2584, 101, 890.673267, 30237.983193, 3.394958, 1.151316),
        (84850, 1616, 1271, 66, 1285.606061, 52506.188119, 4.084158, 1.27144),
    ],
)
def test_kpis_match_feed(spark, spend, impressions, reach, clicks, cpc, cpm, ctr, frequency):
    s, i, r, c = (F.lit(v) for v in (spend, impressions, reach, clicks))
    assert round(one(spark, kpi.cpc(s, c)), 6) == cpc
    assert round(one(spark, kpi.cpm(s, i)), 6) == cpm
    assert round(one(spark, kpi.ctr_pct(c, i)), 6) == ctr
    assert round(one(spark, kpi.frequency(i, r)), 6) == frequency


def test_ratios_without_denominator(spark):
    zero, five = F.lit(0), F.lit(5)
    assert one(spark, kpi.ratio(five, zero)) is None
    assert one(spark, kpi.cost_per(five, zero)) == 0.0
    assert one(spark, kpi.ratio_floored(five, zero)) == 5.0
    assert one(spark, kpi.ctr_fraction(five, zero)) == 0.0


def test_conversions_truncate(spark):
    assert one(spark, kpi.conversions(F.lit(9))) == 7


def test_engagements_count_missing_as_zero(spark):
    n = F.lit(None).cast("int")
    assert one(spark, kpi.engagement_total(F.lit(1), F.lit(2), n, F.lit(4), n, F.lit(6))) == 13


def test_funnel(spark):
    df = spark.createDataFrame([(100, 10, 5), (10, 20, 0)], "impressions int, clicks int, links int")
    steps = [(c, F.col(c)) for c in df.columns]
    assert rows(df.select(*kpi.funnel(steps))) == [(0.1, 0.5, True), (2.0, 0.0, False)]


# --- text ---


def test_keys_follow_md5(spark):
    digest = hashlib.md5(b"seed").hexdigest()
    assert one(spark, text.entity_key(F.lit("seed"), "cam")) == f"cam_{digest[:15]}"
    assert one(spark, text.entity_key(F.lit("seed"), "as", 12)) == f"as_{digest[:12]}"
    assert one(spark, text.numeric_key(F.lit("seed"))) == str(int(digest[:12], 16))[:12]
    assert one(spark, text.tagged_name(F.lit("Ad"), F.lit("seed"))) == f"Ad [#{digest[:3].upper()}]"


def test_keys_are_stable_and_distinct(spark):
    a, b = text.entity_key(F.lit("A"), "ad"), text.entity_key(F.lit("B"), "ad")
    assert one(spark, a) == one(spark, a) != one(spark, b)


def test_sample_is_stable_and_without_repeats(spark):
    pool = [f"p{i}" for i in range(20)]
    df = spark.range(50).select(text.stable_sample(pool, F.col("id").cast("string"), 4).alias("s"))
    samples = [tuple(r.s) for r in df.collect()]
    assert all(len(set(s)) == 4 for s in samples)
    assert len(set(samples)) > 40
    assert samples == [tuple(r.s) for r in df.collect()]


def test_bucket_range(spark):
    df = spark.range(500).select(text.stable_bucket(F.col("id").cast("string"), 7).alias("b"))
    assert {r.b for r in df.collect()} == set(range(7))


@pytest.mark.parametrize(
    "name, expected",
    [
        ("Khách Phụ nữ", ("female", None, None)),
        ("Xe & Nam giới", ("male", None, None)),
        ("Mọi người", (None, None, None)),
        ("Nhóm Quản lý, CEO", (None, 35, 65)),
        ("Nam giới 18-24", ("male", 18, 24)),
        ("CEO 18-24", (None, 35, 65)),
    ],
)
def test_audience(spark, name, expected):
    parts = text.audience(F.lit(name))
    assert tuple(spark.range(1).select(*[c.alias(k) for k, c in parts.items()]).first()) == expected


@pytest.mark.parametrize("bucket, low", [("18-24", 18), ("65+", 65), ("unknown", None)])
def test_age_floor(spark, bucket, low):
    assert one(spark, text.age_floor(F.lit(bucket))) == low


def test_sheet_name(spark):
    assert one(spark, text.sheet_name(F.lit("gad_keyword_performance_report"))) == "keyword_performance_report"
    assert len(one(spark, text.sheet_name(F.lit("x" * 50)))) == 31


def test_inflation_formula(spark):
    value = one(spark, 1 + F.log10(F.greatest(F.lit(1.0), F.lit(100000.0) / 50000)))
    assert value == pytest.approx(1 + math.log10(2))


def test_landing_path(spark):
    assert one(spark, landing_path(F.lit("2026-01-02 03:04:05").cast("timestamp"))) == "2026/01/02/03/04"
