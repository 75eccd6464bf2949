"""Account → campaign → ad set → ad: parent lookups, and group values joined back to rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_ads(
    ads: DataFrame,
    adsets: DataFrame,
    campaigns: DataFrame | None = None,
    accounts: DataFrame | None = None,
) -> DataFrame:
    """Join the dimensions among themselves: one row per ad with all its parents.

    The chain runs on the dimension side and from the top down, so every level is shuffled
    once, on its parent's key, and a fact joined to the result is shuffled once, on
    ``ad_id``. No side is broadcast by a hint: Spark broadcasts a dimension only if its
    measured size is under the threshold, and AQE splits a skewed partition otherwise.
    """
    top = campaigns
    if campaigns is not None and accounts is not None:
        top = campaigns.join(accounts, "account_id")
    return ads.join(adsets if top is None else adsets.join(top, "campaign_id"), "adset_id")


def attach_parents(fact: DataFrame, resolved_ads: DataFrame) -> DataFrame:
    """Inner equi-join of a fact (or report) with the resolved ads."""
    return fact.join(resolved_ads, "ad_id")


def join_group_values(df: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """Join per-group values (an aggregate by ``keys``) back to the rows; NULL is a group too.

    A window over ``keys`` would send a whole group to one task. Here the rows are one plain
    exchange, and because the null-safe join does not accept the aggregate's own partitioning
    the values are another, which is the form in which AQE can split a large group.
    """
    renamed = values.withColumnsRenamed({k: f"__key_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys])
    return df.join(renamed, same).drop(*[f"__key_{k}" for k in keys])
