"""The batch job: lake → bronze → star schema."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adloom.functions.aliases import canonicalise
from adloom.plans import star
from adloom.plans.dates import dim_date
from adloom.session import methods_compiled, shuffles_dropped
from adloom.sinks import warehouse
from adloom.sources.lake import read_landing


def to_bronze(raw: DataFrame, warehouse_root: str, table: str, load_id: str) -> DataFrame:
    """Write the cleaned report once as parquet by month and continue from there.

    JSON arrays cannot be split or pruned, and ten outputs would parse them ten times. The
    parquet copy is read by column instead, needs no cache, and survives lost executors.
    This is also the one shuffle that sorts rows into months: the facts are narrow
    projections of it and are written without another one. Columns the feed does not have are
    neither shuffled nor stored; the declared schema gives them back as NULL.
    """
    path = f"{warehouse_root.rstrip('/')}/bronze/{table}/load_id={load_id}"
    report = star.normalise(raw).withColumns(
        {
            "updated_at": F.coalesce("updated_at", F.current_timestamp()),
            "ym": F.date_format("date_start", "yyyyMM"),
        }
    )
    known = {*canonicalise(raw).columns, "date_stop", "updated_at", "ym"}
    stored = report.select(*[c for c in report.columns if c in known])
    stored.hint("rebalance", F.col("ym")).write.mode("overwrite").partitionBy("ym").parquet(path)
    return raw.sparkSession.read.schema(report.schema).parquet(path).drop("ym")


#: Writes of one run that may share the cluster; each is small beside the bronze write and leaves cores idle at its end.
AT_ONCE = 4


def at_once(spark: SparkSession, jobs: list[Callable[[], object]]) -> list:
    """Results of independent jobs in their order, up to AT_ONCE of them running together; the first failure is raised."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in started]


def run_batch(
    spark: SparkSession,
    lake: str,
    warehouse_root: str,
    load_id: str,
    start: datetime.date | None = None,
    end: datetime.date | None = None,
) -> dict[str, int]:
    """Load the landed social reports into the warehouse; returns the rows written per table.

    ``load_id`` must sort in load order; repeating a load replaces it. With ``start`` or ``end``
    only that range of landing days is read. Of two versions of a key the later landed one is newer.
    """
    def bronze(table: str) -> DataFrame:
        return to_bronze(read_landing(spark, lake, table, start, end, version="updated_at"), warehouse_root, table, load_id)

    # One after the other, so that the disk holds the shuffle of one report at a time.
    with shuffles_dropped(spark), methods_compiled(spark):
        daily, demographics = bronze("fad_ad_daily_report"), bronze("fad_age_gender_detailed_report")
    outputs = {
        **star.ad_daily_tables(daily, default_status="ACTIVE"),
        **star.creative_tables(daily),
        **star.demographic_tables(demographics),
        "dim_date": dim_date(daily),
    }

    def write(table: str, frame: DataFrame) -> Callable[[], int]:
        def job() -> int:
            rows = Observation(f"{table}-{load_id}")
            warehouse.append(frame, warehouse_root, table, load_id, rows, sorted_into_months=not table.startswith("dim_"))
            return rows.get.get("rows", 0)

        return job

    with shuffles_dropped(spark), methods_compiled(spark):
        return dict(zip(outputs, at_once(spark, [write(*output) for output in outputs.items()]), strict=True))
