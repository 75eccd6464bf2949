"""Tolerant conversions: a bad value becomes NULL (or a default), never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def to_double(c: Column) -> Column:
    """Number or numeric text to double; anything else is NULL."""
    return c.try_cast("double")


def to_int(c: Column, source: T.DataType | None = None, target: str = "int") -> Column:
    """Whole number, truncated toward zero: ``"12.7"`` gives 12, out of range gives NULL.

    Text goes through double so that counters written as ``3.0`` survive; an integral
    source column skips that detour and keeps all its digits.
    """
    if isinstance(source, T.IntegralType):
        return c.try_cast(target)
    return c.try_cast("double").try_cast(target)


def to_money(c: Column) -> Column:
    """Money as an exact decimal, so that sums do not depend on the order of rows."""
    return c.try_cast(MONEY)


def to_day(c: Column) -> Column:
    """``yyyy-MM-dd`` text to date; malformed text is NULL.

    A shape check plus the plain cast is several times cheaper per row than a pattern parser.
    """
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c.try_cast("date"))


def to_instant(c: Column) -> Column:
    """``yyyy-MM-dd'T'HH:mm:ss+0700`` text to timestamp; malformed text is NULL."""
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ssZ"))


def number_or_zero(c: Column) -> Column:
    """Numeric text to double, with 0 for anything that is not a number."""
    return F.coalesce(to_double(c), F.lit(0.0))


def convert(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Tolerant conversion chosen from the two column types."""
    if source == target:
        return c
    if isinstance(target, T.DateType):
        if isinstance(source, T.StringType):
            return to_day(c)
        return c.cast(target)
    if isinstance(target, T.TimestampType):
        return to_instant(c) if isinstance(source, T.StringType) else c.cast(target)
    if isinstance(target, T.DoubleType):
        return to_double(c)
    if isinstance(target, T.IntegralType):
        return to_int(c, source, target.simpleString())
    if isinstance(target, T.StringType):
        return c.cast(target)
    return c.try_cast(target)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly the columns of ``schema``: converted if present, typed NULL if not."""
    present = {field.name: field.dataType for field in df.schema.fields}
    columns = []
    for field in schema.fields:
        if field.name in present:
            value = convert(F.col(f"`{field.name}`"), present[field.name], field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replace NULL by a per-column default; a default may be a value or a Column."""
    changed = {}
    for name, default in defaults.items():
        fallback = default if isinstance(default, Column) else F.lit(default)
        changed[name] = F.coalesce(F.col(name), fallback.cast(df.schema[name].dataType))
    return df.withColumns(changed)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Keep the rows in which all named columns are present."""
    return df.dropna(how="any", subset=list(columns))
