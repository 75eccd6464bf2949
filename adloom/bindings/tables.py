"""The driver's tables read as advertising reports.

lineitem → orders → customer → nation → region plays ad row → ad → ad set → campaign → account.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.functions import clean
from adloom.operators.hierarchy import resolve_ads
from adloom.plans import star
from adloom.session import work_dir
from adloom.sources import messages


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh work folder; a local session without ``spark.checkpoint.dir``, as in a trial run, gets a temporary one."""
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().contains("spark.checkpoint.dir")
    if known or not context.master.startswith("local"):
        return work_dir(spark, name)
    return tempfile.mkdtemp(prefix=f"adloom-{name}-")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ad_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily ad metrics with typed columns."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date_start"),
        F.col("l_orderkey").alias("ad_id"),
        F.col("l_partkey").alias("creative_id"),
        F.col("l_suppkey").alias("seg_id"),
        F.col("l_extendedprice").cast(clean.MONEY).alias("spend"),
        F.floor("l_quantity").cast("int").alias("impressions"),
        F.col("l_linenumber").alias("clicks"),
        F.when(F.col("l_returnflag") == "N", "unknown").otherwise(F.col("l_returnflag")).alias("gender"),
        F.col("l_linestatus").alias("age"),
        (F.col("l_linenumber") - 1).alias("new_messaging_connections"),
    )


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ad_id"),
        F.col("o_custkey").alias("adset_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").cast("date").alias("start_date"),
        F.col("o_totalprice").alias("budget"),
    )


def adsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("adset_id"),
        F.col("c_nationkey").alias("campaign_id"),
        F.col("c_name").alias("adset_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").cast(clean.MONEY).alias("daily_budget"),
    )


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("campaign_id"),
        F.col("n_regionkey").alias("account_id"),
        F.col("n_name").alias("campaign_name"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("account_id"), F.col("r_name").alias("account_name")
    )


def parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ad with all its parents."""
    return resolve_ads(
        ads(spark, sf_dir), adsets(spark, sf_dir), campaigns(spark, sf_dir), accounts(spark, sf_dir)
    )


def ad_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily ad metrics with the ids of all parents, for the roll-ups."""
    resolved = resolve_ads(ads(spark, sf_dir), adsets(spark, sf_dir), campaigns(spark, sf_dir))
    keys = resolved.select("ad_id", "adset_id", "campaign_id", "account_id", "daily_budget")
    facts = ad_facts(spark, sf_dir).select(
        "ad_id", "date_start", "spend", "impressions", "clicks", "new_messaging_connections"
    )
    return facts.join(keys, "ad_id")


def raw_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A denormalised daily ad report in the lake feed's own spellings, with gaps."""
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "ad_id")
    named = lines.join(parents(spark, sf_dir), "ad_id")
    line = F.col("l_linenumber")
    return named.select(
        F.col("account_id").cast("string").alias("account_id"),
        F.when(F.col("status") != "P", F.concat_ws(" ", "account_name", "status")).alias("account_name"),
        F.col("campaign_id").cast("string").alias("campaign_id"),
        F.concat_ws(" / ", "campaign_name", "segment").alias("campaign_name"),
        F.col("adset_id").cast("string").alias("ad_set_id"),
        F.concat_ws(" ", "adset_name", "priority").alias("ad_set_name"),
        F.col("ad_id").cast("string").alias("id"),
        F.when(line > 1, F.concat(F.lit("Ad "), F.col("ad_id"), F.lit("-"), line)).alias("name"),
        F.col("l_shipdate").cast("date").alias("date_start"),
        F.when(F.col("status") != "P", F.col("status")).alias("status"),
        F.when(F.col("l_tax") > 0, F.col("l_partkey").cast("string")).alias("creative_id"),
        F.concat(F.lit("Creative "), F.col("l_suppkey")).alias("creative_name"),
        F.col("l_linestatus").alias("age"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("gender"),
        F.col("l_extendedprice").alias("spend"),
        (F.col("l_quantity") * 100).alias("impressions"),
        (F.col("l_quantity") * 95).alias("reach"),
        (line * 3).alias("clicks"),
        F.when(F.col("l_returnflag") != "R", line % 3).alias("newMessagingConnections"),
        (line * 2).alias("linkClicks"),
        line.alias("landingPageViews"),
        F.col("l_suppkey").alias("postReactions"),
    )


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw report after cleaning."""
    return star.normalise(raw_report(spark, sf_dir))


def creative_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the report that needs no parents: dimension lookups read fewer tables."""
    lines = table(spark, sf_dir, "lineitem")
    return star.normalise(
        lines.select(
            F.col("l_orderkey").alias("id"),
            F.col("l_shipdate").cast("date").alias("date_start"),
            F.when(F.col("l_tax") > 0, F.col("l_partkey")).alias("creative_id"),
            F.concat(F.lit("Creative "), F.col("l_suppkey")).alias("creative_name"),
        )
    )


def search_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily search-ad metrics: supplier plays ad group, its nation the campaign. Conversions are fractions, multiples of 3/8."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("adgroup_id"),
        F.col("l_shipdate").cast("date").alias("date_start"),
        F.col("l_extendedprice").cast(clean.MONEY).alias("cost"),
        (F.floor("l_quantity") * 10).alias("impressions"),
        F.col("l_linenumber").cast("long").alias("clicks"),
        (F.rint(F.col("l_discount") * 100) * 0.375).alias("all_conversions"),
    )
    groups = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("adgroup_id"), F.col("s_nationkey").alias("campaign_id")
    )
    return lines.join(groups, "adgroup_id").join(
        campaigns(spark, sf_dir).select("campaign_id", "account_id"), "campaign_id"
    )


def order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ad: totals to be split over breakdown cells."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ad_id"),
        F.col("o_custkey").alias("adset_id"),
        F.col("o_orderdate").cast("date").alias("date_start"),
        F.col("o_totalprice").cast(clean.MONEY).alias("spend"),
        (F.col("o_custkey") * 7 + 11).alias("impressions"),
        (F.col("o_custkey") % 97).alias("clicks"),
        (F.col("o_orderkey") % 31).alias("new_messaging_connections"),
    )


def audience_name(segment: Column) -> Column:
    """An ad-set name whose words say whom it targets."""
    return (
        F.when(segment == "HOUSEHOLD", "Phụ nữ 18-24")
        .when(segment == "MACHINERY", "Xe & Nam giới")
        .when(segment == "BUILDING", "Nhóm Quản lý, CEO")
        .when(segment == "FURNITURE", "Sinh viên 18-24")
        .otherwise("Mọi người")
    )


def targeted_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad totals with the audience-bearing name of their ad set."""
    names = adsets(spark, sf_dir).select("adset_id", audience_name(F.col("segment")).alias("adset_name"))
    return order_totals(spark, sf_dir).join(names, "adset_id")


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows as landing records, with the time of the nightly upload that lands them."""
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.col("event_type").alias("report_type"),
        F.col("value").alias("spend"),
        F.col("props").alias("raw_data"),
        (F.date_trunc("day", ts.cast("timestamp")) + F.expr("interval 26 hours")).alias("landed_at"),
    )


def event_messages(events: DataFrame, named: bool = False) -> DataFrame:
    """Event rows (batch or stream) as wrapped report messages, one ``value`` text column.

    ``named`` messages also carry the names and parents of their ad, which change over time.
    """
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    report_type = (
        F.when(kind == "purchase", "ad_creative")
        .when(kind == "view", "age_gender")
        .when(kind == "signup", "ad_set_daily")
        .otherwise("ad_daily")
    )
    names = [
        F.when(k % 4 > 0, F.concat(F.lit("Ad "), k % 9)).alias("name"),
        (F.col("user_id") % 50).cast("string").alias("ad_set_id"),
        F.when(k % 5 > 0, F.concat(F.lit("Set "), k % 7)).alias("ad_set_name"),
        (F.col("user_id") % 20).cast("string").alias("campaign_id"),
        F.concat(F.lit("Campaign "), k % 11).alias("campaign_name"),
        F.when(k % 3 > 0, F.concat(F.lit("Account "), k % 13)).alias("account_name"),
        F.when(k % 2 > 0, F.lit("PAUSED")).alias("status"),
        F.concat(F.lit("Title "), k % 6).alias("creative_title"),
        F.when(k % 7 > 0, F.concat(F.lit("Page "), k % 8)).alias("page_name"),
    ]
    data = F.struct(
        *(names if named else []),
        F.col("user_id").cast("string").alias("id"),
        (F.col("user_id") % 10).cast("string").alias("account_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("date_start"),
        F.col("value").cast("string").alias("spend"),
        (k * 10).cast("string").alias("impressions"),
        k.cast("string").alias("clicks"),
        k.alias("New Messaging Connections"),
        F.when(kind == "purchase", (k % 5).cast("string")).alias("creative_id"),
        F.when(kind == "view", F.when(k < 50, "18-24").otherwise("25-34")).alias("age"),
        F.when((kind == "view") & (k % 3 > 0), F.when(k % 3 == 1, "female").otherwise("male")).alias("gender"),
    )
    return events.select(
        messages.wrap(
            data,
            F.when(kind == "error", "google").otherwise("facebook"),
            report_type,
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        ).alias("value")
    )


def event_stream(spark: SparkSession, sf_dir: str, named: bool = False) -> DataFrame:
    """Decoded messages as a stream over the events table."""
    schema = table(spark, sf_dir, "events").schema
    stream = messages.parquet_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet", schema)
    return messages.unwrap(event_messages(stream, named))
