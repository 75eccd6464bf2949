"""Social-ads breakdowns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.functions import text
from adloom.operators import allocation
from adloom.operators.rollup import daily_levels, present_metrics, with_names


def demographic_rows(report: DataFrame, name: str = "adset_name", metrics: list[str] | None = None) -> DataFrame:
    """Ad-day totals split over the age×gender cells, weighted by the audience in the ad-set name."""
    targeted = {f"__{k}": v for k, v in text.audience(F.coalesce(name, F.lit(""))).items()}
    rows = allocation.allocate(
        report.withColumns(targeted),
        metrics or present_metrics(report),
        allocation.DEMOGRAPHIC_CELLS,
        allocation.demographic_weights(*[F.col(c) for c in targeted]),
    )
    return rows.drop(*targeted)


def level_reports(report: DataFrame, names: dict[str, DataFrame], metrics: list[str] | None = None) -> DataFrame:
    """Daily reports of ad sets, campaigns and accounts: (level, date_start, id, name, metrics).

    Only the entity's own attributes are kept; ``names`` holds each level's (key, name) dimension.
    The report is summed once for all levels, so the join sees one row per entity and day.
    """
    metrics = metrics or present_metrics(report)
    totals = daily_levels(report, metrics)
    return with_names(totals, names).select("level", "date_start", "id", "name", *metrics)
