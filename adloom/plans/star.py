"""Star schema from cleaned reports: dimensions, facts and the flat report.

Every function takes a frame of ``normalise`` and returns a frame; batch and stream share them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions import clean, kpi
from adloom.functions.aliases import canonicalise
from adloom.operators.latest import newest_attributes
from adloom.schemas import REPORT, WAREHOUSE

#: What makes a report row newer than another one: its day, then its ingest time.
VERSIONS = ["date_start", "updated_at"]


def normalise(df: DataFrame) -> DataFrame:
    """Clean a raw report: canonical headers, tolerant types, absent columns as typed NULLs."""
    report = clean.conform(canonicalise(df), REPORT)
    return report.withColumn("date_stop", F.coalesce("date_stop", "date_start"))


def valid_ads(report: DataFrame) -> DataFrame:
    """Rows that name an ad and a day."""
    return clean.require(report, "id", "date_start")


def _or(column: str, default: str) -> Column:
    return F.coalesce(F.col(column), F.lit(default)).alias(column)


def _dimension(rows: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    return newest_attributes(clean.require(rows, key), key, attributes, VERSIONS).drop("date_start")


def dim_account(report: DataFrame) -> DataFrame:
    rows = report.select("account_id", _or("account_name", "Unknown"), *VERSIONS)
    return _dimension(rows, "account_id", ["account_name"])


def dim_campaign(report: DataFrame) -> DataFrame:
    rows = report.select("campaign_id", "account_id", _or("campaign_name", "Unknown"), *VERSIONS)
    return _dimension(rows, "campaign_id", ["account_id", "campaign_name"])


def dim_adset(report: DataFrame) -> DataFrame:
    rows = report.select("adset_id", "campaign_id", _or("adset_name", "Unknown"), *VERSIONS)
    return _dimension(rows, "adset_id", ["campaign_id", "adset_name"])


def dim_ad(report: DataFrame, default_status: str = "UNKNOWN") -> DataFrame:
    """Ads; a feed without a status column is served with ``default_status="ACTIVE"``."""
    rows = report.select(
        F.col("id").alias("ad_id"),
        "adset_id",
        F.coalesce("name", F.lit("Unknown")).alias("ad_name"),
        _or("status", default_status),
        _or("effective_status", default_status),
        "created_time",
        *VERSIONS,
    )
    return _dimension(rows, "ad_id", ["adset_id", "ad_name", "status", "effective_status", "created_time"])


def dim_creative(report: DataFrame) -> DataFrame:
    rows = report.select(
        "creative_id",
        F.coalesce("creative_title", "creative_name", F.lit("")).alias("creative_title"),
        _or("creative_body", ""),
        _or("creative_thumbnail_raw_url", ""),
        _or("creative_link", ""),
        _or("page_name", "Unknown"),
        *VERSIONS,
    )
    attributes = ["creative_title", "creative_body", "creative_thumbnail_raw_url", "creative_link", "page_name"]
    return _dimension(rows, "creative_id", attributes)


def _count(column: str, alias: str | None = None) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).alias(alias or column)


def _money(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0).cast(clean.MONEY)).alias(column)


def _rate(column: str, computed: Column) -> Column:
    """The feed's ratio, else the one recomputed from the row, else 0."""
    return F.coalesce(F.col(column), computed, F.lit(0.0)).alias(column)


def fact_ad_daily(report: DataFrame) -> DataFrame:
    """One row per reported ad-day."""
    spend, impressions, clicks = F.col("spend"), F.col("impressions"), F.col("clicks")
    messages = F.col("new_messaging_connections")
    return valid_ads(report).select(
        "date_start",
        "account_id",
        F.col("id").alias("ad_id"),
        _money("spend"),
        _count("impressions"),
        _count("reach"),
        _count("clicks"),
        _rate("ctr", kpi.ctr_pct(clicks, impressions)),
        _rate("cpc", kpi.cpc(spend, clicks)),
        _rate("cpm", kpi.cpm(spend, impressions)),
        _rate("frequency", kpi.frequency(impressions, F.col("reach"))),
        _count("new_messaging_connections"),
        _rate("cost_per_new_messaging", kpi.ratio(spend, messages)),
        _count("link_clicks"),
        _count("landing_page_views"),
        "updated_at",
    )


def fact_creative_daily(report: DataFrame) -> DataFrame:
    """One row per reported ad, creative and day."""
    return clean.require(report, "id", "creative_id", "date_start").select(
        "date_start",
        "account_id",
        F.col("id").alias("ad_id"),
        "creative_id",
        _money("spend"),
        *[
            _count(c)
            for c in (
                "impressions",
                "reach",
                "clicks",
                "new_messaging_connections",
                "post_engagements",
                "post_reactions",
                "post_shares",
                "photo_views",
            )
        ],
        "updated_at",
    )


def fact_demographic_daily(report: DataFrame) -> DataFrame:
    """One row per reported ad, age bucket, gender and day."""
    return clean.require(report, "id", "date_start", "age").select(
        "date_start",
        "account_id",
        F.col("id").alias("ad_id"),
        "age",
        _or("gender", "unknown"),
        _money("spend"),
        _count("impressions"),
        _count("reach"),
        _count("clicks"),
        F.coalesce("inline_link_clicks", "link_clicks", F.lit(0)).alias("inline_link_clicks"),
        _count("new_messaging_connections"),
        "updated_at",
    )


def flat_report(report: DataFrame, *extra: Column) -> DataFrame:
    """The denormalised report: every column of the flat warehouse table, and ``extra`` ones."""
    names = {"name", "adset_name", "campaign_name", "account_name"}
    counters = {
        "impressions",
        "reach",
        "clicks",
        "messaging_first_reply",
        "new_messaging_connections",
        "post_comments",
        "link_clicks",
        "landing_page_views",
        "page_likes",
        "thru_play",
    }
    columns = []
    for field in WAREHOUSE["fad_ad_daily_report"].columns:
        if field.name in names:
            columns.append(_or(field.name, ""))
        elif field.name in counters:
            columns.append(_count(field.name))
        elif field.name == "spend":
            columns.append(_money("spend"))
        else:
            columns.append(F.col(field.name))
    return valid_ads(report).select(*columns, *extra)


def ad_daily_tables(report: DataFrame, default_status: str = "UNKNOWN") -> dict[str, DataFrame]:
    """All tables an ad-daily report feeds, except the creative ones."""
    valid = valid_ads(report)
    return {
        "dim_account": dim_account(valid),
        "dim_campaign": dim_campaign(valid),
        "dim_adset": dim_adset(valid),
        "dim_ad": dim_ad(valid, default_status),
        "fact_fb_ad_daily": fact_ad_daily(report),
        "fad_ad_daily_report": flat_report(report, F.col("updated_at").alias("landed_at")),
    }


def creative_tables(report: DataFrame) -> dict[str, DataFrame]:
    """Tables fed by a report with creatives."""
    valid = clean.require(report, "id", "creative_id", "date_start")
    return {"dim_creative": dim_creative(valid), "fact_fb_ad_creative_daily": fact_creative_daily(report)}


def demographic_tables(report: DataFrame) -> dict[str, DataFrame]:
    """Tables fed by an age and gender report."""
    return {"fact_fb_ad_demographic_daily": fact_demographic_daily(report)}
