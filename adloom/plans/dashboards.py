"""The dashboard queries, as DataFrame plans and as SQL over the warehouse views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.functions import kpi
from adloom.operators.hierarchy import attach_parents, resolve_ads


def _with_campaign(fact: DataFrame, ads: DataFrame, adsets: DataFrame, campaigns: DataFrame) -> DataFrame:
    resolved = resolve_ads(
        ads.select("ad_id", "adset_id"),
        adsets.select("adset_id", "campaign_id"),
        campaigns.select("campaign_id", "campaign_name"),
    )
    return attach_parents(fact, resolved.select("ad_id", "campaign_name"))


def spend_by_campaign_day(fact: DataFrame, ads: DataFrame, adsets: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Spend per campaign and day."""
    joined = _with_campaign(fact.select("ad_id", "date_start", "spend"), ads, adsets, campaigns)
    return joined.groupBy("campaign_name", "date_start").agg(F.sum("spend").alias("total_spend"))


def campaign_kpis(fact: DataFrame, ads: DataFrame, adsets: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Daily totals and ratios per campaign, by day. ``cpm`` is messages per hundred clicks."""
    facts = fact.select("ad_id", "date_start", "spend", "new_messaging_connections", "clicks", "impressions")
    totals = (
        _with_campaign(facts, ads, adsets, campaigns)
        .groupBy("date_start", "campaign_name")
        .agg(
            F.sum("spend").alias("total_spend"),
            F.sum("new_messaging_connections").alias("total_messaging"),
            F.sum("clicks").alias("total_clicks"),
            F.sum("impressions").alias("total_impressions"),
        )
    )
    return totals.select(
        "*",
        kpi.cost_per(F.col("total_spend"), F.col("total_messaging")).alias("cost_per_message"),
        kpi.ctr_pct(F.col("total_clicks"), F.col("total_impressions")).alias("ctr"),
        kpi.message_rate_pct(F.col("total_messaging"), F.col("total_clicks")).alias("cpm"),
    ).orderBy("date_start")


def demographic_spend(fact: DataFrame, ads: DataFrame, adsets: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Totals per campaign, age and known gender, by spend. The filter reaches the fact's scan."""
    facts = fact.filter(F.col("gender") != "unknown").select(
        "ad_id", "age", "gender", "spend", "new_messaging_connections", "impressions"
    )
    return (
        _with_campaign(facts, ads, adsets, campaigns)
        .groupBy("campaign_name", "age", "gender")
        .agg(
            F.sum("spend").alias("total_spend"),
            F.sum("new_messaging_connections").alias("total_messaging"),
            F.sum("impressions").alias("total_impressions"),
        )
        .orderBy(F.desc("total_spend"))
    )


# The same three dashboards for a SQL client, over the views of sinks.warehouse.register_views.
_CAMPAIGN_OF_AD = """
WITH parents AS (
  SELECT a.ad_id, c.campaign_name
  FROM dim_ad a
  INNER JOIN dim_adset s USING (adset_id)
  INNER JOIN dim_campaign c ON c.campaign_id = s.campaign_id
)
"""

DASHBOARD_SQL = {
    "spend_by_campaign_day": _CAMPAIGN_OF_AD
    + """
SELECT campaign_name, date_start, sum(spend) AS total_spend
FROM fact_fb_ad_daily INNER JOIN parents USING (ad_id)
GROUP BY campaign_name, date_start
""",
    "campaign_kpis": _CAMPAIGN_OF_AD
    + """, totals AS (
  SELECT date_start, campaign_name,
         sum(spend) AS total_spend,
         sum(new_messaging_connections) AS total_messaging,
         sum(clicks) AS total_clicks,
         sum(impressions) AS total_impressions
  FROM fact_fb_ad_daily INNER JOIN parents USING (ad_id)
  GROUP BY date_start, campaign_name
)
SELECT *,
       coalesce(double(total_spend) / nullif(total_messaging, 0), 0) AS cost_per_message,
       total_clicks / nullif(total_impressions, 0) * 100 AS ctr,
       total_messaging / nullif(total_clicks, 0) * 100 AS cpm
FROM totals ORDER BY date_start
""",
    "demographic_spend": _CAMPAIGN_OF_AD
    + """
SELECT campaign_name, age, gender, sum(spend) AS total_spend,
       sum(new_messaging_connections) AS total_messaging, sum(impressions) AS total_impressions
FROM fact_fb_ad_demographic_daily INNER JOIN parents USING (ad_id)
WHERE gender <> 'unknown'
GROUP BY campaign_name, age, gender
ORDER BY total_spend DESC
""",
}


def run_sql(spark: SparkSession, dashboard: str) -> DataFrame:
    """A dashboard in SQL over the registered warehouse views."""
    return spark.sql(DASHBOARD_SQL[dashboard])
