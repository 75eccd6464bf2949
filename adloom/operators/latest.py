"""One row per key: the newest version wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_version(
    df: DataFrame, keys: list[str], version: str | None = None, tiebreak: list[str] | None = None
) -> DataFrame:
    """Keep the row with the greatest ``version`` per key; equal versions fall to ``tiebreak``.

    By default every other column breaks ties, so the survivor never depends on row order.
    Catalyst turns the ``= 1`` filter into a group limit that runs *before* the shuffle too:
    each task sends at most one row per key, so a key holding a third of all rows is cut
    down to one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c != version]
    ties = rest if tiebreak is None else tiebreak
    order = [F.col(c).desc_nulls_last() for c in ([version] if version else []) + ties]
    newest_first = Window.partitionBy(*keys).orderBy(*order)
    rank = "__rank"
    return df.withColumn(rank, F.row_number().over(newest_first)).filter(F.col(rank) == 1).drop(rank)


def newest_attributes(df: DataFrame, key: str, attributes: list[str], versions: list[str]) -> DataFrame:
    """Dimension rows: for each key the attributes of its newest row, as (key, attributes, versions).

    Versions are compared together, as one tuple: a later landing of an old day does not make
    the old day's attributes newer. The input first shrinks by a hash aggregate with map-side
    combine to its distinct (key, attributes, all versions but the last), and only those rows
    are ranked, behind a group limit that lets one row per key and task through.
    """
    seen = df.groupBy(key, *attributes, *versions[:-1]).agg(F.max(versions[-1]).alias(versions[-1]))
    return latest_version(seen, [key], versions[0], [*versions[1:], *attributes]).select(key, *attributes, *versions)
