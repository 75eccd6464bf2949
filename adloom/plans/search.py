"""Search-ads reports: staging, roll-ups and breakdowns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions import clean, kpi
from adloom.operators import allocation, rollup
from adloom.schemas import LANDING, SEARCH_COUNTS, SEARCH_MONEY, SEARCH_RATIOS


def staged_schema(table: str) -> T.StructType:
    """Typed columns of a staged search report; the feed's ``date`` becomes ``date_start``."""
    fields = []
    for name in LANDING[table].split():
        if name == "date":
            fields.append(T.StructField("date_start", T.DateType()))
        elif name in SEARCH_MONEY:
            fields.append(T.StructField(name, clean.MONEY))
        elif name in SEARCH_COUNTS:
            fields.append(T.StructField(name, T.LongType()))
        elif name in SEARCH_RATIOS:
            fields.append(T.StructField(name, T.DoubleType()))
        else:
            fields.append(T.StructField(name, T.StringType()))
    return T.StructType(fields)


def stage(df: DataFrame, table: str, extra: list[T.StructField] | None = None) -> DataFrame:
    """Clean a landed search report into its typed columns, and ``extra`` ones."""
    renamed = df.withColumnRenamed("date", "date_start") if "date" in df.columns else df
    return clean.conform(renamed, T.StructType([*staged_schema(table).fields, *(extra or [])]))


def asset_rows(ads: DataFrame, items: str, seed: Column) -> DataFrame:
    """Ad-day totals split over the ad's assets (structs, all fields kept), with each asset's click-through fraction."""
    weighted = ads.withColumn("__share", allocation.item_weights(seed, items))
    size = F.lit(1000) * F.size(items)
    parts = allocation.allocate_items(weighted, list(rollup.SEARCH_METRICS), items, "__share", size)
    return parts.withColumn("ctr_fraction", kpi.ratio_floored(F.col("clicks"), F.col("impressions")))


def with_search_ratios(rows: DataFrame) -> DataFrame:
    """Derived columns of a breakdown row, denominators floored at 1."""
    counted = rows.withColumn("conversions", kpi.conversions(F.col("all_conversions")).cast("long"))
    cost, clicks = F.col("cost"), F.col("clicks")
    return counted.withColumns(
        {
            "ctr_fraction": kpi.ratio_floored(clicks, F.col("impressions")),
            "average_cpc": kpi.ratio_floored(cost, clicks),
            "cost_per_conversion": kpi.ratio_floored(cost, F.col("conversions")),
        }
    )


def breakdown(groups: DataFrame, cells, seed: Column) -> DataFrame:
    """Group-day totals split over keywords, ages or genders by stable shares, ratios added."""
    size = len(cells)
    parts = allocation.allocate(
        groups,
        list(rollup.SEARCH_METRICS),
        cells,
        allocation.share_weights(seed, size),
        F.lit(1000 * size),
    )
    return with_search_ratios(parts)


def breakdown_items(groups: DataFrame, items: str, seed: Column) -> DataFrame:
    """The same over a list held in each row: an array of structs, all fields kept; a row without items emits nothing."""
    weighted = groups.withColumn("__share", allocation.item_weights(seed, items))
    size = F.lit(1000) * F.size(items)
    return with_search_ratios(allocation.allocate_items(weighted, list(rollup.SEARCH_METRICS), items, "__share", size))


LEVELS = {"ad_group": "adgroup_id", "campaign": "campaign_id", "account": "account_id"}


def level_reports(rows: DataFrame, names: dict[str, DataFrame]) -> DataFrame:
    """Daily reports of ad groups, campaigns and accounts, summed once, the ratio recomputed per level."""
    metrics = list(rollup.SEARCH_METRICS)
    finest = rollup.numeric_feed(rows).groupBy("date_start", *LEVELS.values()).agg(*rollup.sums(metrics))
    return reports_of(finest, names)


def reports_of(finest: DataFrame, names: dict[str, DataFrame]) -> DataFrame:
    """The same from sums of ad groups' days, of which a day may have several rows."""
    metrics = list(rollup.SEARCH_METRICS)
    totals = rollup.by_level(finest, LEVELS, ["date_start"], rollup.sums(metrics))
    ratio = kpi.ctr_fraction(F.col("clicks"), F.col("impressions")).alias("ctr_fraction")
    return rollup.with_names(totals, names).select("level", "date_start", "id", "name", *metrics, ratio)


def click_types(campaigns: DataFrame, seed: Column) -> DataFrame:
    """Campaign-day totals split by click type; parts are truncated one by one and need not add up."""
    cells = [{"click_type": name} for name in allocation.CLICK_TYPES]
    size = len(cells)
    exact = campaigns.withColumns(
        {f"__{c}": F.col(c).cast("double") for c in ("impressions", "clicks", "all_conversions")}
    )
    rows = allocation.split_open(
        exact,
        ["impressions", "clicks", "cost"],
        cells,
        allocation.share_weights(seed, size),
        F.lit(1000 * size),
    )
    share = F.col("share")
    return rows.withColumns(
        {
            "ctr_fraction": F.col("__clicks") * share / F.greatest(F.lit(1.0), F.col("__impressions") * share),
            "conversions": F.floor(F.col("__all_conversions") * share * F.lit(0.8)),
            "all_conversions": F.col("__all_conversions") * share,
        }
    ).drop("share", "__impressions", "__clicks", "__all_conversions")


def union_breakdowns(*parts: DataFrame) -> DataFrame:
    """All breakdown rows in one frame; columns a breakdown lacks are NULL."""
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result
