"""Histories of attributes: validity intervals by change detection, and facts joined as of their day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adloom.operators.latest import latest_version

_MONTH = "__month"


def validity(df: DataFrame, key: str, attributes: list[str], day: str = "date_start", landed: str = "updated_at") -> DataFrame:
    """(key, attributes, valid_from, valid_to, is_current): one row per run of days with the same attributes.

    Of several rows of a key and day the last landed one counts (then the greatest attributes).
    A row opens a new interval if any attribute differs, NULL included, from the day before it;
    ``valid_to`` is the first day of the next interval, open (NULL) for the current one. Rows
    without a key or day are left out.

    The input first shrinks to one row per key and day by a group limit ahead of the shuffle, so
    the windows over a key hold its days at most, whatever share of the rows it owns.
    """
    rows = df.select(key, *attributes, day, landed).where(F.col(key).isNotNull() & F.col(day).isNotNull())
    days = latest_version(rows, [key, day], landed, attributes)
    by_day = Window.partitionBy(key).orderBy(day)
    now, before = F.struct(*attributes), F.lag(F.struct(*attributes)).over(by_day)
    # A struct of NULLs is not NULL, so only the first day has no predecessor.
    changed = days.withColumn("__before", before).where(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(now))
    until = F.lead(day).over(by_day)
    return changed.select(key, *attributes, F.col(day).alias("valid_from"), until.alias("valid_to"), until.isNull().alias("is_current"))


def as_of(facts: DataFrame, history: DataFrame, key: str, day: str = "date_start") -> DataFrame:
    """Each fact with the attributes that were valid on its day (NULL before the first interval); all facts stay.

    Equi-join on key and month: an interval appears once in every month it covers, and one that
    is still open up to the last fact, so a fact meets the few intervals of its month instead of
    its key's whole history, and a key's facts spread over the months. Columns of ``history``
    other than the key must not occur in ``facts``.
    """
    first_of_month = lambda c: F.trunc(c, "month")
    last = facts.select(F.max(day)).scalar()
    until = F.least(F.coalesce(F.date_sub("valid_to", 1), last), last)
    spans = (
        history.withColumn("__until", until)
        .where(F.col("valid_from") <= F.col("__until"))
        .withColumn(_MONTH, F.explode(F.sequence(first_of_month("valid_from"), first_of_month("__until"), F.expr("interval 1 month"))))
        .drop("__until")
    )
    return _matched(facts.withColumn(_MONTH, first_of_month(F.col(day))), spans, key, day).drop(_MONTH)


def _matched(facts: DataFrame, spans: DataFrame, key: str, day: str) -> DataFrame:
    right = spans.withColumnsRenamed({key: "__key", _MONTH: "__right_month"})
    conditions: list[Column] = [
        F.col(key) == F.col("__key"),
        F.col(_MONTH) == F.col("__right_month"),
        F.col("valid_from") <= F.col(day),
        F.col("valid_to").isNull() | (F.col(day) < F.col("valid_to")),
    ]
    return facts.join(right, reduce(lambda a, b: a & b, conditions), "left").drop("__key", "__right_month")
