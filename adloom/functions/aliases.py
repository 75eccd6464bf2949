"""Header spellings: one metric arrives in camelCase, as a human heading, or in snake_case."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The feed's own spellings, canonical name first.
CAMEL = {
    "adset_id": "ad_set_id",
    "adset_name": "ad_set_name",
    "link_clicks": "linkClicks",
    "landing_page_views": "landingPageViews",
    "messaging_first_reply": "messagingFirstReply",
    "new_messaging_connections": "newMessagingConnections",
    "post_comments": "postComments",
    "post_shares": "postShares",
    "post_saves": "postSaves",
    "post_reactions": "postReactions",
    "photo_views": "photoViews",
    "page_likes": "pageLikes",
    "post_engagements": "postEngagements",
    "thru_play": "thruPlay",
    "video_views_p25": "videoViewsP25",
    "video_views_p50": "videoViewsP50",
    "video_views_p75": "videoViewsP75",
    "video_views_p95": "videoViewsP95",
    "video_views_p100": "videoViewsP100",
}

# Headings of the exported reports, partly Vietnamese.
HEADING = {
    "new_messaging_connections_n": "New Messaging Connections (N)",
    "cost_per_new_messaging_n": "Cost per New Messaging (N)",
    "new_messaging_connections": "New Messaging Connections",
    "cost_per_new_messaging": "Cost per New Messaging",
    "leads": "Leads",
    "cost_leads": "Cost Leads",
    "purchases": "Purchases",
    "cost_purchases": "Cost Purchases",
    "purchase_value": "Purchase Value",
    "purchase_roas": "Purchase ROAS",
    "website_purchases": "Website Purchases",
    "on_facebook_purchases": "On-Facebook Purchases",
    "post_comments": "Post comments",
    "post_engagements": "Post engagements",
    "post_reactions": "Post reactions",
    "post_shares": "Post shares",
    "photo_views": "Photo views",
    "link_clicks": "Link clicks",
    "cost_per_unique_link_click": "Cost per unique link click",
    "leads_conversion_value": "Leads Conversion Value",
    "landing_page_views": "Landing page views",
    "cost_per_landing_page_view": "Cost per landing page view",
    "adds_to_cart": "Adds to cart",
    "cost_per_add_to_cart": "Cost per add to cart",
    "checkouts_initiated": "Checkouts Initiated",
    "cost_per_checkout_initiated": "Cost per checkout initiated",
    "completed_registration": "Hoàn tất đăng ký",
    "cost_per_completed_registration": "Chi phí / Hoàn tất đăng ký",
    "thru_play": "ThruPlay",
    "cost_per_thru_play": "Chi phí / ThruPlay",
    "page_likes": "Page Likes",
    "cost_page_likes": "Cost Page Likes",
    "video_views_3s": "Video Views (3s)",
    "video_views_30s": "Video Views (30s)",
    "video_views_p25": "Video Views (25%)",
    "video_views_p50": "Video Views (50%)",
    "video_views_p75": "Video Views (75%)",
    "video_views_p100": "Video Views (100%)",
    "video_plays": "Video Plays",
    "avg_time_watched": "Avg Time Watched",
}


def spellings(canonical: str) -> list[str]:
    """All known spellings of one column, none twice under case-insensitive resolution.

    A heading such as ``Leads`` differs from ``leads`` by case only; the heading is kept,
    because JSON field names match by case and the feed writes the heading.
    """
    found: dict[str, str] = {}
    for name in (HEADING.get(canonical), CAMEL.get(canonical), canonical):
        if name and name.lower() not in found:
            found[name.lower()] = name
    return list(found.values())


def canonicalise(df: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """Rename every known spelling to its canonical column; unknown columns pass through.

    Where a frame carries several spellings of one column (a union of feeds), the first
    non-NULL value is kept, headings before camelCase before snake_case.
    """
    present = {name.lower(): name for name in df.columns}
    targets = wanted or [*dict.fromkeys([*HEADING, *CAMEL])]
    used: set[str] = set()
    columns = []
    for target in targets:
        sources = [present[s.lower()] for s in spellings(target) if s.lower() in present]
        if not sources:
            continue
        used.update(sources)
        if sources != [target]:
            columns.append((target, reduce(F.coalesce, [F.col(f"`{s}`") for s in sources])))
    renamed = {target for target, _ in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in used or (c in targets and c not in renamed)]
    return df.select(*kept, *[expr.alias(name) for name, expr in columns])
