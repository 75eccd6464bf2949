"""Split an entity's totals over breakdown cells.

All splits are computed inside the entity's own row: the remainder that the last cell gets is
a column expression, and one generator emits the cells. There
is no join, no window and no shuffle, so the plan is the same at any scale and no entity can
become a hot group.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions import clean, text
from adloom.operators.hierarchy import join_group_values

# The breakdown cells of the feeds.
AGES = ("18-24", "25-34", "35-44", "45-54", "55-64", "65+")
GENDERS = ("female", "male")
SEARCH_AGES = (
    "AGE_RANGE_18_24",
    "AGE_RANGE_25_34",
    "AGE_RANGE_35_44",
    "AGE_RANGE_45_54",
    "AGE_RANGE_55_64",
    "AGE_RANGE_65_UP",
    "AGE_RANGE_UNDETERMINED",
)
SEARCH_GENDERS = ("MALE", "FEMALE", "UNDETERMINED")
DEVICES = ("MOBILE", "DESKTOP", "TABLET")
CLICK_TYPES = ("URL_CLICKS", "AD_IMAGE", "HEADLINE", "SITELINKS", "CALLS")

# Weight of an age bucket, in 1/20000 so that all products stay whole numbers:
# 3.0 for 25-34 and 35-44, 0.3 for 65+, 1.0 otherwise; times 0.05 outside the targeted age
# range and 0.01 for the gender that is not targeted.
WEIGHT_UNIT = 20000
AGE_BASE = {"25-34": 60000, "35-44": 60000, "65+": 6000}
OUT_OF_AGE = 20
OTHER_GENDER = 100
WEIGHT_FLOOR = 0.0001

DEMOGRAPHIC_CELLS = tuple({"age": age, "gender": gender} for age in AGES for gender in GENDERS)


def emit_cells(df: DataFrame, cells, ordinal: str | None = None) -> DataFrame:
    """Every row once per cell: a fixed, literal breakdown list, generated in place."""
    names = list(cells[0])
    literals = []
    for position, cell in enumerate(cells):
        literals += [F.lit(position + 1)] if ordinal else []
        literals += [_literal(cell[n]) for n in names]
    return df.select(
        "*", F.stack(F.lit(len(cells)), *literals).alias(*([ordinal] if ordinal else []), *names)
    )


def demographic_weights(gender: Column, age_min: Column, age_max: Column) -> list[Column]:
    """Weight of each age×gender cell for a targeted audience (see ``text.audience``)."""
    weights = []
    for cell in DEMOGRAPHIC_CELLS:
        youngest = int(cell["age"].split("-")[0].rstrip("+"))
        outside = (age_min > youngest) | (age_max < youngest)
        other = gender != cell["gender"]
        base = AGE_BASE.get(cell["age"], WEIGHT_UNIT)
        in_age = F.when(other, base // OTHER_GENDER).otherwise(base)
        off_age = F.when(other, base // OUT_OF_AGE // OTHER_GENDER).otherwise(base // OUT_OF_AGE)
        weights.append(F.when(outside, off_age).otherwise(in_age).cast("long"))
    return weights


def normalise(df: DataFrame, keys: list[str], weight: str, share: str = "share") -> DataFrame:
    """Weight divided by the sum of its group, the sum being at least 0.0001.

    The group sums are aggregated with map-side combine and joined back, so that a large group
    is spread over tasks.
    """
    totals = df.groupBy(*keys).agg(F.sum(weight).cast("double").alias("__total"))
    joined = join_group_values(df, totals, keys)
    return joined.withColumn(
        share, F.col(weight) / F.greatest(F.lit(WEIGHT_FLOOR), F.col("__total"))
    ).drop("__total")


def _part(total: Column, weight: Column, denominator: Column, kind: str) -> Column:
    """A leading cell's part: truncated for counters, half-even to a cent for money, exact for fractions."""
    exact = total * weight / denominator
    return exact if kind == "fraction" else (F.rint(exact) if kind == "money" else F.floor(exact)).cast("long")


def allocate(
    df: DataFrame,
    metrics: list[str],
    cells,
    weights: list[Column],
    denominator: Column | None = None,
) -> DataFrame:
    """Split each metric over a fixed cell list so that the parts add up to the total exactly.

    Cell ``i`` gets ``total * weight_i / denominator`` (by default the weights' sum); the last
    cell gets what is left, which is negative if the leading shares exceed 1. Decimal
    metrics are split in cents, whole numbers as such, floating ones without rounding. Other columns are kept.
    """
    items = F.array(*[F.struct(*[_literal(value).alias(name) for name, value in cell.items()]) for cell in cells])
    listed = df.withColumns({"__items": items, "__weights": F.array(*[w.cast("double") for w in weights])})
    return allocate_items(listed, metrics, "__items", "__weights", denominator)


def _literal(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _kind(data_type: T.DataType) -> str:
    if isinstance(data_type, T.DecimalType):
        return "money"
    return "fraction" if isinstance(data_type, (T.DoubleType, T.FloatType)) else "counter"


def _total(metric: str, kind: str) -> Column:
    """A total as it is split: a counter, money in cents (over its whole range), or a fraction; missing counts as 0."""
    if kind == "fraction":
        return F.coalesce(F.col(metric).cast("double"), F.lit(0.0))
    value = F.round(F.col(metric) * 100) if kind == "money" else F.col(metric)
    return F.coalesce(value.cast("long"), F.lit(0))


def _cents_to_money(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(clean.MONEY)


def allocate_items(
    df: DataFrame, metrics: list[str], items: str, weights: str, denominator: Column | None = None
) -> DataFrame:
    """Like ``allocate`` for a breakdown list held in the row: an array of structs (or values).

    ``weights`` is an array aligned with ``items``; lists may differ in length between rows,
    and a row without items emits nothing. Struct items are expanded into their fields.

    Only the remainder of each metric is computed before the cells are generated; a cell's
    own part is one product afterwards. This keeps the generated code small, however many
    cells and metrics there are.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    split = {m: _kind(kinds[m]) for m in metrics}
    kept = [c for c in df.columns if c not in (*metrics, items, weights)]
    if denominator is None:
        denominator = F.greatest(
            F.lit(WEIGHT_FLOOR), F.aggregate(weights, F.lit(0.0), lambda total, w: total + w.cast("double"))
        )

    totals = df.withColumns({m: _total(m, split[m]) for m in metrics}).withColumn(
        "__den", denominator.cast("double")
    )
    last = F.greatest(F.size(items) - 1, F.lit(0))

    def remainder(metric: str) -> Column:
        def subtract(left: Column, weight: Column) -> Column:
            return left - _part(F.col(metric), weight.cast("double"), F.col("__den"), split[metric])

        return F.aggregate(F.slice(weights, 1, last), F.col(metric), subtract)

    cells = totals.select(
        *kept,
        *metrics,
        *[remainder(m).alias(f"__rest_{m}") for m in metrics],
        "__den",
        last.alias("__last"),
        F.posexplode(F.arrays_zip(F.col(items).alias("item"), F.col(weights).alias("weight"))).alias("__i", "__cell"),
    )
    parts = []
    for m in metrics:
        part = _part(F.col(m), F.col("__cell.weight").cast("double"), F.col("__den"), split[m])
        whole = F.when(F.col("__i") == F.col("__last"), F.col(f"__rest_{m}")).otherwise(part)
        parts.append((_cents_to_money(whole) if split[m] == "money" else whole).alias(m))
    structs = isinstance(kinds[items].elementType, T.StructType)
    item = F.col("__cell.item.*") if structs else F.col("__cell.item").alias(items)
    return cells.select(*kept, item, *parts)


def share_weights(seed: Column, size: int) -> list[Column]:
    """A stable weight of 500 … 1500 per cell; over ``1000 * size`` that is a share around 1/size."""
    return [text.stable_bucket(F.concat(seed, F.lit(f"_{i}")), 1001) + 500 for i in range(size)]


def item_weights(seed: Column, items: str) -> Column:
    """The same weights for a list held in the row, aligned with it."""
    return F.transform(
        items, lambda _, i: text.stable_bucket(F.concat(seed, F.lit("_"), i.cast("string")), 1001) + 500
    )


def split_open(df: DataFrame, counters: list[str], cells, weights: list[Column], denominator: Column) -> DataFrame:
    """Share split without a remainder: each cell truncates on its own, the parts need not add up."""
    with_cells = emit_cells(
        df, [{**cell, "__w": w.cast("double")} for cell, w in zip(cells, weights)]
    )
    share = F.col("__w") / denominator.cast("double")
    parts = {c: F.floor(F.col(c).cast("double") * share) for c in counters}
    return with_cells.withColumn("share", share).withColumns(parts).drop("__w")
