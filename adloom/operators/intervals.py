"""Interval joins by time bins: overlaps without a row per day and without a nested loop."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BIN = "__bin"


def _bin(day: Column, width: int) -> Column:
    return F.floor(F.unix_date(day) / F.lit(width))


def _binned(df: DataFrame, start: str, end: str, width: int) -> DataFrame:
    """One row per interval and bin it touches; intervals that end before they start, or lack a bound, go."""
    bins = F.sequence(_bin(F.col(start), width), _bin(F.col(end), width))
    return df.where(F.col(start) <= F.col(end)).withColumn(_BIN, F.explode(bins))


def overlaps(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    bin_days: int,
) -> DataFrame:
    """Pairs of rows with equal ``on`` columns whose closed day intervals share a day, each pair once.

    Adds ``overlap_start`` and ``overlap_end``. Both sides are cut into bins of ``bin_days`` and joined by
    equality on the bin; the exact test follows, and a pair that meets in several bins counts in
    the first they share: the bin of the later start. A bin near the usual length of an interval
    keeps both the copies and the false meetings few. Column names of the two sides must differ.
    ``on`` may be empty: the bin alone is then the key, which AQE can split where it is hot.
    """
    a, b = _binned(left, *left_span, bin_days), _binned(right, *right_span, bin_days).withColumnRenamed(_BIN, "__other")
    start, end = F.greatest(left_span[0], right_span[0]), F.least(left_span[1], right_span[1])
    conditions = [
        *(F.col(x) == F.col(y) for x, y in on),
        F.col(_BIN) == F.col("__other"),
        start <= end,
        F.col(_BIN) == _bin(start, bin_days),
    ]
    pairs = a.join(b, reduce(lambda x, y: x & y, conditions))
    return pairs.drop(_BIN, "__other").withColumns({"overlap_start": start, "overlap_end": end})


def overlapping_pairs(df: DataFrame, key: str, group: list[str], start: str, end: str, bin_days: int) -> DataFrame:
    """Pairs (``a`` before ``b`` by key) of one table's rows of the same group whose intervals overlap, each once."""
    side = lambda name: df.select(
        F.col(key).alias(name), *[F.col(g).alias(f"__{name}_{g}") for g in group], F.col(start).alias(f"{name}_start"), F.col(end).alias(f"{name}_end")
    )
    on = [(f"__a_{g}", f"__b_{g}") for g in group]
    pairs = overlaps(side("a"), side("b"), on, ("a_start", "a_end"), ("b_start", "b_end"), bin_days).where(F.col("a") < F.col("b"))
    return pairs.withColumnsRenamed({f"__a_{g}": g for g in group}).drop(*[f"__b_{g}" for g in group])
