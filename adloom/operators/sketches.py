"""Reach by mergeable sketches: distinct people per ad and day, united along the hierarchy and over days."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Buckets of a sketch, as a power of two: 4,096 buckets, 2.6 KB at most.
LG_BUCKETS = 12


def relative_error(lg_buckets: int = LG_BUCKETS, deviations: float = 4.0) -> float:
    """Bound of an estimate's relative error that holds but for about one estimate in ten thousand (four deviations)."""
    return deviations * 1.04 / math.sqrt(2**lg_buckets)


def reach_sketches(rows: DataFrame, keys: list[str], person: str, lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """(keys, reach_sketch): one sketch of the people of each group; NULL people count as none.

    Sketches are built by each task before the shuffle, so a group costs one sketch a task,
    whatever share of the rows it owns.
    """
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(person, lg_buckets).alias("reach_sketch"))


def united(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, reach_sketch): sketches of finer groups united; someone in several of them counts once, unlike in a sum."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("reach_sketch").alias("reach_sketch"))


def estimated(sketches: DataFrame) -> DataFrame:
    """``reach_sketch`` replaced by ``reach``, the estimated number of distinct people."""
    return sketches.withColumn("reach", F.hll_sketch_estimate("reach_sketch")).drop("reach_sketch")
