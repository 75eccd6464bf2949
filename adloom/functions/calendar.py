"""Calendar attributes of a day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (first month, first day, last month, last day, name); the first match wins.
HOLIDAYS = (
    (1, 1, 1, 1, "Tết Dương Lịch"),
    (1, 15, 2, 5, "Tết Nguyên Đán"),
    (4, 30, 4, 30, "Ngày Giải Phóng Miền Nam"),
    (5, 1, 5, 1, "Ngày Quốc Tế Lao Động"),
    (9, 2, 9, 2, "Quốc Khánh"),
)

# Fixed values: (first month, first day, last month, last day, factor).
SOCIAL_PEAKS = ((1, 15, 2, 5, 1.8),)
SEARCH_PEAKS = ((2, 10, 2, 14, 2.5), (3, 5, 3, 8, 2.0))


def iso_weekday(day: Column) -> Column:
    """1 = Monday … 7 = Sunday."""
    return F.weekday(day) + 1


def in_season(day: Column, m1: int, d1: int, m2: int, d2: int) -> Column:
    """Is the day of the year between two (month, day) bounds, both included?"""
    position = F.month(day) * 100 + F.dayofmonth(day)
    return position.between(m1 * 100 + d1, m2 * 100 + d2)


def holiday_name(day: Column, holidays=HOLIDAYS) -> Column:
    """Name of the holiday, or NULL. ``holidays`` is data: pass another calendar to change it."""
    names = [F.when(in_season(day, *rule[:4]), F.lit(rule[4])) for rule in holidays]
    return reduce(F.coalesce, names) if names else F.lit(None).cast("string")


def is_weekend(day: Column) -> Column:
    """Saturday or Sunday."""
    return iso_weekday(day) >= 6


def day_attributes(day: Column, holidays=HOLIDAYS) -> dict[str, Column]:
    """Calendar attributes of a day by name; the calendar dimension gives them their order and types."""
    numbers = {
        "year": F.year,
        "quarter": F.quarter,
        "month": F.month,
        "week": F.weekofyear,
        "day_of_year": F.dayofyear,
        "day_of_month": F.dayofmonth,
        "day_of_week": iso_weekday,
        "is_weekend": is_weekend,
    }
    names = {"month_name": "MMMM", "day_name": "EEEE"}
    holiday = holiday_name(day, holidays)
    return (
        {name: number(day).cast("int") for name, number in numbers.items()}
        | {name: F.date_format(day, pattern) for name, pattern in names.items()}
        | {"is_holiday": holiday.isNotNull().cast("int"), "holiday_name": holiday}
    )


def _season_factor(day: Column, weekend_from: int, weekend_factor: float, peaks) -> Column:
    factor = F.when(iso_weekday(day) >= weekend_from, F.lit(weekend_factor)).otherwise(F.lit(1.0))
    for m1, d1, m2, d2, peak in peaks:
        factor = factor * F.when(in_season(day, m1, d1, m2, d2), F.lit(peak)).otherwise(F.lit(1.0))
    return factor


def social_season_factor(day: Column) -> Column:
    """Price pressure on the social platform: Friday to Sunday 1.4, new-year season times 1.8."""
    return _season_factor(day, 5, 1.4, SOCIAL_PEAKS)


def search_season_factor(day: Column) -> Column:
    """Price pressure on the search platform: weekend 1.3, gift days times 2.5 and 2.0."""
    return _season_factor(day, 6, 1.3, SEARCH_PEAKS)


def fraction_of_day(ts: Column) -> Column:
    """Share of the day that has passed, from 0 up to (not including) 1."""
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return seconds / F.lit(86400.0)


def run_rate(value: Column, ts: Column) -> Column:
    """Projection of a partial day's value to the whole day; NULL before the first second."""
    return value / F.nullif(fraction_of_day(ts), F.lit(0.0))


def days_active(start: Column, day: Column) -> Column:
    """Age of an entity in days, never negative."""
    return F.greatest(F.lit(0), F.datediff(day, start))
