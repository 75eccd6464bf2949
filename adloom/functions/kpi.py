"""Ratios and totals. Ratios are always recomputed from sums, never averaged."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL where the denominator is 0."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, 0 where there is nothing to divide by."""
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def ratio_floored(numerator: Column, denominator: Column) -> Column:
    """Quotient whose denominator is at least 1."""
    return numerator.cast("double") / F.greatest(F.lit(1.0), denominator.cast("double"))


def ctr_pct(clicks: Column, impressions: Column) -> Column:
    """Click-through rate in percent."""
    return ratio(clicks, impressions) * 100


def ctr_fraction(clicks: Column, impressions: Column) -> Column:
    """Click-through rate as a fraction, 0 without impressions."""
    return ratio_or_zero(clicks, impressions)


def cpc(spend: Column, clicks: Column) -> Column:
    """Cost per click."""
    return ratio(spend, clicks)


def cpm(spend: Column, impressions: Column) -> Column:
    """Cost per thousand impressions."""
    return ratio(spend * 1000, impressions)


def frequency(impressions: Column, reach: Column) -> Column:
    """Mean impressions per person reached."""
    return ratio(impressions, reach)


def cost_per(spend: Column, count: Column) -> Column:
    """Cost per event, 0 if there was none."""
    return ratio_or_zero(spend, count)


def message_rate_pct(messages: Column, clicks: Column) -> Column:
    """Messages per hundred clicks (the detail dashboard shows it under the name ``cpm``)."""
    return ratio(messages, clicks) * 100


def engagement_total(
    clicks: Column, comments: Column, shares: Column, reactions: Column, saves: Column, photo_views: Column
) -> Column:
    """All engagements of a post."""
    parts = (clicks, comments, shares, reactions, saves, photo_views)
    total = F.lit(0)
    for part in parts:
        total = total + F.coalesce(part, F.lit(0))
    return total


def conversions(all_conversions: Column) -> Column:
    """Counted conversions: four fifths of all conversions, truncated."""
    return F.floor(all_conversions.cast("double") * F.lit(0.8))


def funnel(steps: list[tuple[str, Column]]) -> list[Column]:
    """Step conversion rates of a funnel plus ``is_monotone``: no step exceeds the one before; a missing step counts as 0."""
    rates = []
    monotone = F.lit(True)
    for (_, above), (name, below) in zip(steps, steps[1:]):
        rates.append(ratio(below, above).alias(f"{name}_rate"))
        monotone = monotone & (F.coalesce(below, F.lit(0)) <= F.coalesce(above, F.lit(0)))
    return [*rates, monotone.alias("is_monotone")]


# The two chains of a social report that must not grow from step to step.
VIDEO_FUNNEL = (
    "impressions", "video_views_p25", "video_views_p50", "video_views_p75", "video_views_p95", "video_views_p100"
)
CLICK_FUNNEL = ("impressions", "clicks", "link_clicks", "landing_page_views")


def report_funnels(chains=(VIDEO_FUNNEL, CLICK_FUNNEL)) -> list[Column]:
    """Step rates of all chains, and ``is_monotone``: every chain is."""
    rates, monotone = [], F.lit(True)
    for chain in chains:
        *steps, whole = funnel([(name, F.col(name)) for name in chain])
        rates += steps
        monotone = monotone & whole
    return [*rates, monotone.alias("is_monotone")]
