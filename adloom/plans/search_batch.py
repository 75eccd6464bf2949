"""The search batch job: landed search reports → staged parquet → daily level reports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.operators import rollup
from adloom.plans import search
from adloom.schemas import LANDING
from adloom.session import shuffles_dropped
from adloom.sources.lake import read_landing

#: Entity of a search report: a landing states an entity's day anew, with all its rows.
ENTITIES = {
    "gad_ad_asset_daily_report": "ad_id",
    "gad_keyword_performance_report": "adgroup_id",
    "gad_age_report": "adgroup_id",
    "gad_gender_report": "adgroup_id",
    "gad_click_type_report": "campaign_id",
    "gad_ad_group_daily_report": "id",
    "gad_campaign_daily_report": "id",
    "gad_account_daily_report": "id",
}
VERSION = "landed_at"


def stage_reports(spark: SparkSession, lake: str, root: str, load_id: str, start=None, end=None) -> None:
    """Write every landed search report, typed, as parquet by month; repeating a load replaces it.

    A report that was never landed gives an empty load. Rows without a day or entity are left out.
    """
    for table, entity in ENTITIES.items():
        landed = read_landing(spark, lake, table, start, end, version=VERSION)
        typed = landed.select(*LANDING[table].split(), VERSION)
        staged = search.stage(typed, table, [T.StructField(VERSION, T.TimestampType())])
        rows = staged.dropna(subset=[entity, "date_start"]).withColumn("ym", F.date_format("date_start", "yyyyMM"))
        target = f"{root.rstrip('/')}/{table}/load_id={load_id}"
        rows.hint("rebalance", F.col("ym")).write.mode("overwrite").partitionBy("ym").parquet(target)


def read_staged(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Current rows of a staged report: of every entity and day all rows of its newest landing.

    The window's groups are single entity-days, bounded however large an entity is.
    """
    schema = search.staged_schema(table)
    stored = T.StructType([*schema.fields, T.StructField(VERSION, T.TimestampType()), T.StructField("load_id", T.StringType())])
    try:
        loads = spark.read.schema(stored).parquet(f"{root.rstrip('/')}/{table}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    state = F.struct(VERSION, "load_id")
    newest = F.max(state).over(Window.partitionBy(ENTITIES[table], "date_start"))
    current = loads.withColumn("__newest", newest).filter(state == F.col("__newest"))
    return current.select(*schema.names)


def level_reports(spark: SparkSession, root: str) -> DataFrame:
    """Daily reports of ad groups, campaigns and accounts from the staged asset rows, under their newest names.

    The rows are merged to their newest landing once, and summed to an ad group's days under each of its names; those
    sums are written, as the reports and the names of all levels are taken from them.
    """
    assets = read_staged(spark, root, "gad_ad_asset_daily_report")
    metrics = list(rollup.SEARCH_METRICS)
    keys = ["date_start", *search.LEVELS.values(), *[key.replace("_id", "_name") for key in search.LEVELS.values()]]
    path = f"{root.rstrip('/')}/asset_days"
    days = assets.groupBy(*keys).agg(*rollup.sums(metrics))
    days.write.mode("overwrite").parquet(path)
    assets = spark.read.schema(days.schema).parquet(path)
    names = {}
    for level, key in search.LEVELS.items():
        name = key.replace("_id", "_name")
        newest = F.max_by(name, F.struct("date_start", name))
        names[level] = assets.filter(F.col(key).isNotNull()).groupBy(key).agg(newest)
    return search.reports_of(assets, names)


def run_search_batch(spark: SparkSession, lake: str, root: str, load_id: str, start=None, end=None) -> DataFrame:
    """Stage the landed search reports of a day range and write the level reports of all staged rows anew; returns them."""
    target = f"{root.rstrip('/')}/level_reports"
    with shuffles_dropped(spark):
        stage_reports(spark, lake, root, load_id, start, end)
        reports = level_reports(spark, root).withColumn("ym", F.date_format("date_start", "yyyyMM"))
        reports.hint("rebalance", F.col("ym")).write.mode("overwrite").partitionBy("level", "ym").parquet(target)
    return spark.read.schema(reports.schema).parquet(target).drop("ym")
