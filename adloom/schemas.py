"""Table definitions of the warehouse and the field lists of the feeds."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from adloom.functions.aliases import spellings

S, D, TS, I, F8 = T.StringType(), T.DateType(), T.TimestampType(), T.IntegerType(), T.DoubleType()
B, SH, MONEY = T.ByteType(), T.ShortType(), T.DecimalType(18, 2)


def _fields(*groups: tuple[T.DataType, str]) -> list[T.StructField]:
    return [T.StructField(name, kind) for kind, names in groups for name in names.split()]


@dataclass(frozen=True)
class TableSpec:
    """Columns, key, version column and defaults of one warehouse table."""

    name: str
    columns: list[T.StructField]
    key: list[str]
    version: str | None = "updated_at"
    month_of: str | None = None
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType(self.columns)


def _zeros(columns: list[T.StructField]) -> dict[str, object]:
    return {f.name: 0 for f in columns if isinstance(f.dataType, (T.IntegerType, T.DoubleType, T.DecimalType))}


FACT_DAILY = _fields(
    (D, "date_start"),
    (S, "account_id ad_id"),
    (MONEY, "spend"),
    (I, "impressions reach clicks"),
    (F8, "ctr cpc cpm frequency"),
    (I, "new_messaging_connections"),
    (F8, "cost_per_new_messaging"),
    (I, "link_clicks landing_page_views"),
    (TS, "updated_at"),
)
FACT_CREATIVE = _fields(
    (D, "date_start"),
    (S, "account_id ad_id creative_id"),
    (MONEY, "spend"),
    (
        I,
        "impressions reach clicks new_messaging_connections post_engagements post_reactions"
        " post_shares photo_views",
    ),
    (TS, "updated_at"),
)
FACT_DEMOGRAPHIC = _fields(
    (D, "date_start"),
    (S, "account_id ad_id age gender"),
    (MONEY, "spend"),
    (I, "impressions reach clicks inline_link_clicks new_messaging_connections"),
    (TS, "updated_at"),
)
FLAT_REPORT = _fields(
    (S, "id name adset_id adset_name campaign_id campaign_name account_id account_name"),
    (D, "date_start date_stop"),
    (S, "status effective_status"),
    (TS, "created_time"),
    (MONEY, "spend"),
    (I, "impressions reach clicks"),
    (F8, "ctr cpc cpm frequency"),
    (I, "messaging_first_reply"),
    (F8, "cost_per_messaging_first_reply"),
    (I, "new_messaging_connections"),
    (F8, "cost_per_new_messaging"),
    (I, "leads"),
    (F8, "cost_leads"),
    (I, "purchases"),
    (F8, "cost_purchases purchase_value purchase_roas"),
    (I, "website_purchases on_facebook_purchases completed_registration"),
    (F8, "cost_per_completed_registration"),
    (I, "thru_play"),
    (F8, "cost_per_thru_play"),
    (I, "post_comments link_clicks"),
    (F8, "cost_per_unique_link_click leads_conversion_value"),
    (I, "landing_page_views"),
    (F8, "cost_per_landing_page_view"),
    (I, "adds_to_cart"),
    (F8, "cost_per_add_to_cart"),
    (I, "checkouts_initiated"),
    (F8, "cost_per_checkout_initiated"),
    (I, "page_likes"),
    (F8, "cost_page_likes"),
)

WAREHOUSE = {
    spec.name: spec
    for spec in (
        TableSpec("dim_account", _fields((S, "account_id account_name"), (TS, "updated_at")), ["account_id"]),
        TableSpec(
            "dim_campaign",
            _fields((S, "campaign_id account_id campaign_name"), (TS, "updated_at")),
            ["campaign_id"],
        ),
        TableSpec("dim_adset", _fields((S, "adset_id campaign_id adset_name"), (TS, "updated_at")), ["adset_id"]),
        TableSpec(
            "dim_ad",
            _fields((S, "ad_id adset_id ad_name status effective_status"), (TS, "created_time updated_at")),
            ["ad_id"],
        ),
        TableSpec(
            "dim_creative",
            _fields(
                (
                    S,
                    "creative_id creative_title creative_body creative_thumbnail_raw_url creative_link page_name",
                ),
                (TS, "updated_at"),
            ),
            ["creative_id"],
        ),
        TableSpec(
            "fact_fb_ad_daily",
            FACT_DAILY,
            ["account_id", "ad_id", "date_start"],
            month_of="date_start",
            defaults=_zeros(FACT_DAILY),
        ),
        TableSpec(
            "fact_fb_ad_creative_daily",
            FACT_CREATIVE,
            ["account_id", "ad_id", "creative_id", "date_start"],
            month_of="date_start",
            defaults=_zeros(FACT_CREATIVE),
        ),
        TableSpec(
            "fact_fb_ad_demographic_daily",
            FACT_DEMOGRAPHIC,
            ["account_id", "ad_id", "age", "gender", "date_start"],
            month_of="date_start",
            defaults=_zeros(FACT_DEMOGRAPHIC),
        ),
        # No version column of its own: the last load wins (see sinks.warehouse).
        TableSpec(
            "fad_ad_daily_report",
            FLAT_REPORT,
            ["account_id", "date_start", "date_stop", "campaign_id", "adset_id", "id"],
            version=None,
            month_of="date_start",
        ),
        TableSpec(
            "dim_date",
            _fields(
                (D, "date"),
                (SH, "year"),
                (B, "quarter month"),
                (S, "month_name"),
                (B, "week"),
                (SH, "day_of_year"),
                (B, "day_of_month day_of_week"),
                (S, "day_name"),
                (B, "is_weekend is_holiday"),
                (S, "holiday_name"),
            ),
            ["date"],
            version=None,
        ),
    )
}

# Cleaned form of any social report row, whichever feed and spelling it came from.
REPORT = T.StructType(
    _fields(
        (S, "account_id account_name campaign_id campaign_name adset_id adset_name id name"),
        (D, "date_start date_stop"),
        (S, "status effective_status"),
        (TS, "created_time"),
        (
            S,
            "creative_id creative_name creative_title creative_body creative_thumbnail_raw_url"
            " creative_link page_name age gender",
        ),
        (MONEY, "spend daily_budget"),
        (
            I,
            "impressions reach clicks inline_link_clicks link_clicks landing_page_views messaging_first_reply"
            " new_messaging_connections post_comments post_shares post_saves post_reactions photo_views"
            " page_likes post_engagements thru_play video_views_p25 video_views_p50 video_views_p75"
            " video_views_p95 video_views_p100 leads purchases website_purchases on_facebook_purchases"
            " completed_registration adds_to_cart checkouts_initiated",
        ),
        (
            F8,
            "ctr cpc cpm frequency cost_per_messaging_first_reply cost_per_new_messaging cost_leads"
            " cost_purchases purchase_value purchase_roas cost_per_completed_registration cost_per_thru_play"
            " cost_per_unique_link_click leads_conversion_value cost_per_landing_page_view"
            " cost_per_add_to_cart cost_per_checkout_initiated cost_page_likes",
        ),
        (TS, "updated_at"),
    )
)

_SOCIAL_IDS = "account_id account_name campaign_id campaign_name adset_id adset_name id name date_start date_stop"
_SOCIAL_COUNTS = (
    "spend impressions reach clicks link_clicks landing_page_views messaging_first_reply"
    " new_messaging_connections post_comments post_shares post_saves post_reactions photo_views page_likes"
    " post_engagements thru_play video_views_p25 video_views_p50 video_views_p75 video_views_p95"
    " video_views_p100 daily_budget"
)
_SOCIAL = f"{_SOCIAL_IDS} user_id creative_id creative_name {_SOCIAL_COUNTS}"
_SEARCH_IDS = "campaign_id campaign_name account_id account_name date"
_SEARCH_SPLIT = (
    f"adgroup_id adgroup_name {_SEARCH_IDS} device impressions clicks cost all_conversions ctr conversions"
    " average_cpc cost_per_conversion"
)

#: Landing table → canonical field names.
LANDING = {
    "fad_ad_daily_report": _SOCIAL,
    "fad_age_gender_detailed_report": f"{_SOCIAL} age gender",
    "fad_ad_set_daily_report": f"{_SOCIAL} budget_remaining",
    "fad_campaign_daily_report": _SOCIAL,
    "fad_account_daily_report": _SOCIAL,
    "fad_ad_performance_report": _SOCIAL,
    "fad_ad_set_performance_report": _SOCIAL,
    "fad_campaign_overview_report": _SOCIAL,
    "gad_ad_asset_daily_report": (
        f"ad_id asset_id adgroup_id adgroup_name {_SEARCH_IDS} asset_name asset_type asset_text image_url"
        " asset_performance impressions clicks ctr all_conversions cost"
    ),
    "gad_keyword_performance_report": f"{_SEARCH_SPLIT} keyword match_type keyword_status quality_score",
    "gad_age_report": f"{_SEARCH_SPLIT} age_range",
    "gad_gender_report": f"{_SEARCH_SPLIT} gender",
    "gad_click_type_report": (
        f"{_SEARCH_IDS} click_type campaign_status device ad_network_type impressions clicks ctr conversions"
        " all_conversions cost"
    ),
    "gad_ad_group_daily_report": "id name date impressions clicks cost all_conversions ctr",
    "gad_campaign_daily_report": "id name date impressions clicks cost all_conversions ctr",
    "gad_account_daily_report": "id name date account_id impressions clicks cost all_conversions ctr",
}

#: Search report fields by type, for staging (see plans.search).
SEARCH_MONEY = {"cost", "average_cpc", "cost_per_conversion"}
SEARCH_COUNTS = {"impressions", "clicks", "conversions"}
SEARCH_RATIOS = {"ctr", "all_conversions"}

#: Stream report type → canonical payload field names.
PAYLOADS = {
    "ad_daily": (
        "id name campaign_id campaign_name adset_id adset_name account_id account_name date_start status"
        " effective_status created_time spend impressions reach clicks ctr cpc cpm frequency"
        " new_messaging_connections cost_per_new_messaging link_clicks landing_page_views"
    ),
    "ad_creative": (
        "id account_id creative_id creative_title creative_body creative_thumbnail_raw_url creative_link"
        " page_name date_start spend impressions reach clicks new_messaging_connections post_engagements"
        " post_reactions post_shares photo_views"
    ),
    "age_gender": (
        "id account_id date_start age gender spend impressions reach clicks inline_link_clicks"
        " new_messaging_connections"
    ),
}

#: Message envelope; the payload object stays JSON text because it is declared a string.
ENVELOPE = T.StructType(
    [
        T.StructField(
            "metadata",
            T.StructType(_fields((S, "platform report_type ingested_at crawling_type"))),
        ),
        T.StructField("data", S),
    ]
)


def text_fields(names: str) -> T.StructType:
    """All known spellings of the named fields, as text: feeds mix numbers and numeric strings."""
    return T.StructType([T.StructField(s, S) for name in names.split() for s in spellings(name)])


def landing_schema(table: str) -> T.StructType:
    """Read schema of a landing table."""
    return text_fields(LANDING[table])


def payload_schema(report_type: str) -> T.StructType:
    """Parse schema of a stream payload."""
    return text_fields(PAYLOADS[report_type])
