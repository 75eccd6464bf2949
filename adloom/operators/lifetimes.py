"""Entity lifetimes and date windows."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def active_days(
    df: DataFrame, intervals: list[tuple[Column, Column]], day: str = "date_start"
) -> DataFrame:
    """One row per entity and day on which *all* its intervals are open (bounds included).

    ``day BETWEEN start AND end`` against a calendar would be a range join. The same rows
    come from a generated day sequence per entity, without any join or shuffle.
    """
    starts = [start for start, _ in intervals]
    ends = [end for _, end in intervals]
    first = F.greatest(*starts) if len(starts) > 1 else starts[0]
    last = F.least(*ends) if len(ends) > 1 else ends[0]
    step = F.expr("interval 1 day")
    return (
        df.withColumns({"__first": first, "__last": last})
        .filter(F.col("__first") <= F.col("__last"))
        .withColumn(day, F.explode(F.sequence("__first", "__last", step)))
        .drop("__first", "__last")
    )


def between_days(
    df: DataFrame,
    start: datetime.date | str | None = None,
    end: datetime.date | str | None = None,
    column: str = "date_start",
) -> DataFrame:
    """Rows of a day range, both ends included; the filter reaches the parquet scan."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(end).cast("date"))
    return df


def last_days(df: DataFrame, days: int, column: str = "date_start") -> DataFrame:
    """The window of the last ``days`` days before the newest day in the data, ends included.

    The newest day is a scalar subquery inside the same plan, not a value fetched to the driver.
    """
    newest = df.select(F.max(column)).scalar()
    return df.filter(F.col(column) >= F.date_sub(newest, days))


def day_spine(df: DataFrame, column: str = "date_start") -> DataFrame:
    """Every calendar day from the first to the last day in the data; empty for empty input."""
    bounds = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).dropna()
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))


def distinct_years(df: DataFrame, column: str = "date_start") -> DataFrame:
    """Years touched by the data, ascending."""
    return _years(df, column).orderBy("year")


def _years(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.year(column).alias("year")).distinct()


def years_with_previous(df: DataFrame, column: str = "date_start") -> DataFrame:
    """The years touched by the data and the year before each of them, without repeats, ascending.

    Both years come from one scan by a generator; the only sort is of the few distinct years.
    """
    both = _years(df, column).select(F.explode(F.array(F.col("year"), F.col("year") - 1)).alias("year"))
    return both.distinct().orderBy("year")
