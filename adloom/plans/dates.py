"""The calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.functions import clean
from adloom.functions.calendar import HOLIDAYS, day_attributes
from adloom.operators.lifetimes import day_spine
from adloom.schemas import WAREHOUSE


def dim_date(df: DataFrame, column: str = "date_start", holidays=HOLIDAYS) -> DataFrame:
    """One row per day between the first and the last day of the data.

    The bounds stay inside the plan (a one-row aggregate that is expanded), nothing is
    collected; the size is the number of days, whatever the size of the data.
    """
    days = day_spine(df, column).withColumns(day_attributes(F.col("date"), holidays))
    return clean.conform(days, WAREHOUSE["dim_date"].schema)
