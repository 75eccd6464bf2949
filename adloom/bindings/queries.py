"""One entry per operator: ``(spark, sf_dir) -> DataFrame`` over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.bindings import tables as t
from adloom.functions import calendar, clean, kpi, text
from adloom.functions.aliases import canonicalise
from adloom.operators import allocation, funnels, history, intervals, lifetimes, rollup, sketches
from adloom.operators.hierarchy import join_group_values
from adloom.operators.latest import latest_version
from adloom.plans import batch, dashboards, incremental, search, search_batch, social, star
from adloom.plans.dates import dim_date
from adloom.sinks import files, merge, warehouse
from adloom.sources import intake, lake, messages
from adloom.streaming import pipeline

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


def plain(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, for comparison with other engines."""
    return df.withColumns(
        {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    )


# --- sources and sinks -----------------------------------------------------------------

EVENT_FIELDS = "event_id user_id report_type spend raw_data"


def _typed_events(df: DataFrame, *more: Column) -> DataFrame:
    return df.select(
        clean.to_int(F.col("event_id"), target="bigint").alias("event_id"),
        clean.to_int(F.col("user_id"), target="bigint").alias("user_id"),
        "report_type",
        clean.to_double(F.col("spend")).alias("spend"),
        "raw_data",
        *more,
    )


def _event_schema() -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in EVENT_FIELDS.split()])


@query
def scan_json_lake(spark, sf_dir):
    root = t.scratch(spark, "lake")
    files.write_landing_arrays(t.event_records(spark, sf_dir), root, "events", "landed_at")
    return _typed_events(lake.read_landing(spark, root, "events", schema=_event_schema()))


@query
def scan_json_lines(spark, sf_dir):
    """Files of lines and files of arrays side by side, read with default arguments."""
    root = t.scratch(spark, "lake")
    records = t.event_records(spark, sf_dir)
    even = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    files.write_landing(records.where(even), root, "events", "landed_at")
    files.write_landing_arrays(records.where(~even), root, "events", "landed_at")
    return _typed_events(lake.read_landing(spark, root, "events", schema=_event_schema()))


@query
def load_ledger(spark, sf_dir):
    """Records of a lake that grows between two intakes, one file of it taken a second time; each with the run that took it."""
    base, schema = t.scratch(spark, "intake"), _event_schema()
    records = t.event_records(spark, sf_dir)
    even = F.col("event_id") % 2 == 0
    files.write_landing(records.where(even), f"{base}/lake", "events", "landed_at")
    intake.run_intake(spark, f"{base}/lake", "events", base, schema)
    files.write_landing_arrays(records.where(~even), f"{base}/lake", "events", "landed_at")
    intake.run_intake(spark, f"{base}/lake", "events", base, schema)
    second = F.col("load") > "intake-000000000"
    # The first file of the first run again: its records come from the replay alone.
    path = intake.files_taken(spark, base).where(~second).agg(F.min("path")).first()[0]
    intake.replay(spark, f"{base}/lake", "events", base, path, schema)
    found = intake.read_bronze(spark, base, "events", schema, origin=True)
    run = F.when(second & ~F.col("load").startswith("replay"), 2).otherwise(1)
    counted = intake.files_taken(spark, base).agg(F.sum("records")).scalar()
    return _typed_events(found, run.alias("run"), counted.alias("in_ledger"))


@query
def scan_missing_table(spark, sf_dir):
    absent = lake.read_landing(spark, t.scratch(spark, "lake"), "absent", schema=_event_schema())
    present = t.event_records(spark, sf_dir).drop("landed_at")
    return _typed_events(absent.unionByName(present.select([F.col(c).cast("string") for c in present.columns])))


@query
def sink_json_partitioned(spark, sf_dir):
    root = t.scratch(spark, "lake")
    files.write_landing(t.event_records(spark, sf_dir), root, "events", "landed_at")
    landed = lake.read_landing(spark, root, "events", schema=_event_schema(), origin="path")
    folder = F.regexp_extract(
        F.col("path"), r"yyyy=(\d+)/mm=(\d+)/dd=(\d+)/hh=(\d+)/mi=(\d+)/", 0
    )
    folder = F.rtrim(F.regexp_replace(folder, r"[a-z]+=", ""), F.lit("/"))
    return (
        landed.select(folder.alias("landing_path"), clean.to_int(F.col("event_id"), target="bigint").alias("event_id"))
        .groupBy("landing_path")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("event_id").alias("id_sum"))
    )


@query
def row_counts(spark, sf_dir):
    counts = [
        t.table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("table_name"), "records")
        for name in ("lineitem", "orders", "customer", "nation", "region", "events")
    ]
    return search.union_breakdowns(*counts)


@query
def fact_month_partition(spark, sf_dir):
    path = t.scratch(spark, "facts")
    facts = t.ad_facts(spark, sf_dir).select("date_start", "ad_id", "creative_id", "spend", "clicks")
    files.write_by_month(facts, path, "date_start", ["ad_id", "date_start"])
    stored = spark.read.schema("ad_id bigint, spend decimal(18,2), clicks int, ym string").parquet(path)
    return plain(
        stored.groupBy("ym").agg(
            F.count(F.lit(1)).alias("records"), F.sum("spend").alias("spend"), F.sum("clicks").alias("clicks")
        )
    )


# --- projections, filters, conversions -------------------------------------------------


@query
def project_rename(spark, sf_dir):
    line = F.col("l_linenumber")
    feed = t.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_partkey").alias("ad_set_id"),
        F.when(F.col("l_returnflag") != "R", line).alias("Link clicks"),
        (line * 10).alias("linkClicks"),
        F.col("l_suppkey").alias("newMessagingConnections"),
        F.col("l_quantity").alias("Video Views (25%)"),
        F.col("l_tax").alias("Chi phí / ThruPlay"),
        F.col("l_discount").alias("cost_leads"),
    )
    return canonicalise(feed)


@query
def project_defaults(spark, sf_dir):
    gaps = t.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ad_id"),
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("account_name"),
        F.when(F.col("l_tax") > 0, F.col("l_linenumber")).alias("clicks"),
        F.when(F.col("l_discount") > 0, F.col("l_extendedprice")).alias("spend"),
        F.lit("ACTIVE").alias("status"),
        F.lit(0.0).alias("ctr"),
        F.lit(None).cast("string").alias("page_name"),
    )
    return clean.with_defaults(gaps, {"account_name": "Unknown", "clicks": 0, "spend": 0.0, "page_name": ""})


def _dirty(value: Column, key: Column) -> Column:
    """The value as text, with the damage that feeds show."""
    kind = key % 8
    return (
        F.when(kind == 0, F.lit("n/a"))
        .when(kind == 1, F.lit(""))
        .when(kind == 2, F.lit("12.7"))
        .when(kind == 3, F.lit("-3.9"))
        .when(kind == 4, F.concat(F.lit("  "), value.cast("string"), F.lit(" ")))
        .when(kind == 5, F.lit("99999999999"))
        .when(kind == 6, F.lit("1e3"))
        .otherwise(value.cast("string"))
    )


@query
def cast_tolerant(spark, sf_dir):
    dirty = t.table(spark, sf_dir, "events").select(
        "event_id", _dirty(F.col("value"), F.col("event_id")).alias("x")
    )
    x = F.col("x")
    return plain(
        dirty.select(
            "event_id",
            clean.to_int(x).alias("as_int"),
            clean.to_double(x).alias("as_double"),
            clean.to_money(x).alias("as_money"),
            clean.number_or_zero(x).alias("or_zero"),
        )
    )


@query
def filter_valid(spark, sf_dir):
    rows = t.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_tax") > 0, F.col("l_orderkey")).alias("id"),
        F.when(F.col("l_discount") > 0, F.col("l_shipdate").cast("date")).alias("date_start"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("age"),
        F.col("l_linenumber").alias("clicks"),
    )
    return clean.require(rows, "id", "date_start", "age")


@query
def parse_dates(spark, sf_dir):
    kind = F.col("event_id") % 5
    text_day = (
        F.when(kind == 0, F.lit("not a day"))
        .when(kind == 1, F.lit("2024-02-30"))
        .when(kind == 2, F.lit(""))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    return t.table(spark, sf_dir, "events").select("event_id", clean.to_day(text_day).alias("date_start"))


@query
def parse_timestamps(spark, sf_dir):
    kind = F.col("event_id") % 4
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text_time = (
        F.when(kind == 0, F.lit("yesterday"))
        .when(kind == 1, F.concat(local, F.lit("+0700")))
        .when(kind == 2, F.concat(local, F.lit("-0330")))
        .otherwise(F.concat(local, F.lit("+0000")))
    )
    return t.table(spark, sf_dir, "events").select(
        "event_id", F.unix_seconds(clean.to_instant(text_time)).alias("created_epoch")
    )


@query
def json_envelope(spark, sf_dir):
    decoded = messages.unwrap(t.event_messages(t.table(spark, sf_dir, "events")))
    payload = F.from_json("raw_data", "id string, spend string, clicks string")
    return decoded.select("platform", "report_type", "ingested_at", payload.alias("d")).select(
        "platform", "report_type", "ingested_at", "d.id", clean.to_double(F.col("d.spend")).alias("spend"), clean.to_int(F.col("d.clicks")).alias("k")
    )


@query
def json_roundtrip(spark, sf_dir):
    source = t.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    written = source.select(F.to_json(F.struct("*")).alias("line"))
    return written.select(F.from_json("line", source.schema).alias("d")).select("d.*")


# --- star schema -----------------------------------------------------------------------


@query
def dim_account(spark, sf_dir):
    return star.dim_account(t.report(spark, sf_dir)).drop("updated_at")


@query
def dim_campaign(spark, sf_dir):
    return star.dim_campaign(t.report(spark, sf_dir)).drop("updated_at")


@query
def dim_adset(spark, sf_dir):
    return star.dim_adset(t.report(spark, sf_dir)).drop("updated_at")


@query
def dim_ad(spark, sf_dir):
    return star.dim_ad(t.report(spark, sf_dir)).drop("created_time", "updated_at")


@query
def dim_creative(spark, sf_dir):
    return star.dim_creative(t.creative_report(spark, sf_dir)).drop("updated_at")


@query
def fact_ad_daily(spark, sf_dir):
    return plain(star.fact_ad_daily(t.report(spark, sf_dir)).drop("updated_at"))


@query
def fact_creative_daily(spark, sf_dir):
    return plain(star.fact_creative_daily(t.report(spark, sf_dir)).drop("updated_at"))


@query
def fact_demographic_daily(spark, sf_dir):
    return plain(star.fact_demographic_daily(t.report(spark, sf_dir)).drop("updated_at"))


@query
def flat_report(spark, sf_dir):
    flat = star.flat_report(t.report(spark, sf_dir))
    return plain(
        flat.select(
            "id",
            "name",
            "adset_id",
            "adset_name",
            "campaign_id",
            "campaign_name",
            "account_id",
            "account_name",
            "date_start",
            "date_stop",
            "spend",
            "impressions",
            "reach",
            "clicks",
            "messaging_first_reply",
            "new_messaging_connections",
            "post_comments",
            "link_clicks",
            "landing_page_views",
            "page_likes",
            "thru_play",
        )
    )


@query
def latest_version_query(spark, sf_dir):
    rows = t.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_partkey", "l_extendedprice"
    )
    return latest_version(rows, ["l_orderkey", "l_linenumber"], "l_shipdate")


def _restated(spark, sf_dir) -> DataFrame:
    """The raw report landed twice: odd lines at double spend, and a day later all lines but the seventh."""
    raw = t.raw_report(spark, sf_dir)
    year = F.date_trunc("year", F.col("date_start").cast("timestamp"))
    first = F.when(F.expr("clicks % 2 = 1"), _statement(year, spend=F.col("spend") * 2))
    later = F.when(F.expr("clicks <> 21"), _statement(year + F.expr("interval 1 day"), spend=F.col("spend")))
    return _stated(raw, first, later)


def _statement(landed_at: Column, **values: Column) -> Column:
    """What one landing of a row says: its time and the columns it changes."""
    return F.struct(*[value.alias(name) for name, value in values.items()], landed_at.alias("landed_at"))


def _stated(rows: DataFrame, *statements: Column) -> DataFrame:
    """Every row once for each of its statements that is not NULL; the rows are read and joined once for all landings."""
    listed = rows.withColumn("__said", F.explode(F.filter(F.array(*statements), lambda s: s.isNotNull())))
    said = listed.schema["__said"].dataType.names
    return listed.select(*[c for c in rows.columns if c not in said], "__said.*")


#: Warehouse folders of the session's finished batch jobs, so that its outputs can be compared after one run.
_STARS: dict[tuple[str, str], str] = {}


def _star(spark, sf_dir, anew: bool = False) -> str:
    """Warehouse folder of a finished batch job."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STARS or anew:
        _STARS[key] = _run_star(spark, sf_dir)
    return _STARS[key]


def _run_star(spark, sf_dir) -> str:
    lake_root, target = t.scratch(spark, "lake"), t.scratch(spark, "warehouse")
    landed = _restated(spark, sf_dir)
    files.write_landing(landed.drop("age", "gender"), lake_root, "fad_ad_daily_report", "landed_at")
    files.write_landing(landed, lake_root, "fad_age_gender_detailed_report", "landed_at")
    batch.run_batch(spark, lake_root, target, "load-000001")
    return target


@query
def batch_lake_to_star(spark, sf_dir):
    """Every fact of the batch job, of two landings the later one."""
    target = _star(spark, sf_dir, anew=True)
    parts = []
    for name in ("fact_fb_ad_daily", "fact_fb_ad_creative_daily", "fact_fb_ad_demographic_daily"):
        current = warehouse.read_current(spark, target, name)
        parts.append(
            current.groupBy("account_id").agg(
                F.count(F.lit(1)).alias("records"),
                F.sum("spend").alias("spend"),
                F.sum("clicks").alias("clicks"),
            ).select(F.lit(name).alias("table_name"), "account_id", "records", "spend", "clicks")
        )
    return plain(search.union_breakdowns(*parts))


#: Dimension → its key, parent, name and status; an empty one is NULL.
_ENTITIES = {
    "dim_account": ("account_id", "", "account_name", ""),
    "dim_campaign": ("campaign_id", "account_id", "campaign_name", ""),
    "dim_adset": ("adset_id", "campaign_id", "adset_name", ""),
    "dim_ad": ("ad_id", "adset_id", "ad_name", "status"),
    "dim_creative": ("creative_id", "", "creative_title", "page_name"),
    "dim_date": ("date", "year", "day_name", "holiday_name"),
}


def _entities(spark, target: str, names: list[str]) -> DataFrame:
    """Current rows of dimensions in one shape: (table_name, key, parent, name, status)."""
    parts = []
    for table in names:
        shape = zip(("key", "parent", "name", "status"), _ENTITIES[table])
        columns = [(F.col(c) if c else F.lit(None)).cast("string").alias(alias) for alias, c in shape]
        parts.append(warehouse.read_current(spark, target, table).select(F.lit(table).alias("table_name"), *columns))
    return search.union_breakdowns(*parts)


@query
def batch_dims(spark, sf_dir):
    """The dimensions of the batch job, calendar included: (table_name, key, parent, name, status)."""
    target = _star(spark, sf_dir)
    return _entities(spark, target, list(_ENTITIES))


@query
def batch_flat_report(spark, sf_dir):
    """The flat report of the batch job."""
    flat = warehouse.read_current(spark, _star(spark, sf_dir), "fad_ad_daily_report")
    return plain(flat.select("id", "account_id", "date_start", "spend", "impressions", "reach", "clicks", "link_clicks"))


@query
def batch_search(spark, sf_dir):
    """The search job: asset rows landed twice, with fractions; level reports of the later landing of each ad's day."""
    lake_root, target = t.scratch(spark, "lake"), t.scratch(spark, "search")
    rows = t.search_ads(spark, sf_dir).select(
        F.concat(F.col("adgroup_id"), F.lit("-"), F.col("clicks")).alias("ad_id"),
        F.col("adgroup_id").cast("string").alias("adgroup_id"),
        F.concat(F.lit("Group "), "adgroup_id").alias("adgroup_name"),
        F.col("campaign_id").cast("string").alias("campaign_id"),
        F.concat(F.lit("Campaign "), "campaign_id").alias("campaign_name"),
        F.col("account_id").cast("string").alias("account_id"),
        F.concat(F.lit("Account "), "account_id").alias("account_name"),
        F.col("date_start").cast("string").alias("date"),
        F.col("cost").cast("string").alias("cost"),
        "impressions",
        "clicks",
        "all_conversions",
        F.date_trunc("year", F.col("date_start").cast("timestamp")).alias("year"),
    )
    first = _statement(F.col("year"), impressions=F.col("impressions") * 2)
    later = _statement(F.col("year") + F.expr("interval 1 day"), impressions=F.col("impressions"))
    landed = _stated(rows, first, F.when(F.expr("clicks % 2 = 1"), later)).drop("year")
    files.write_landing(landed, lake_root, "gad_ad_asset_daily_report", "landed_at")
    return plain(search_batch.run_search_batch(spark, lake_root, target, "load-000001"))


# --- dashboards ------------------------------------------------------------------------


def _dims(spark, sf_dir):
    return t.ads(spark, sf_dir), t.adsets(spark, sf_dir), t.campaigns(spark, sf_dir)


@query
def dash_spend_by_campaign_day(spark, sf_dir):
    return plain(dashboards.spend_by_campaign_day(t.ad_facts(spark, sf_dir), *_dims(spark, sf_dir)))


@query
def dash_campaign_kpis(spark, sf_dir):
    return plain(dashboards.campaign_kpis(t.ad_facts(spark, sf_dir), *_dims(spark, sf_dir)))


@query
def dash_demographic(spark, sf_dir):
    return plain(dashboards.demographic_spend(t.ad_facts(spark, sf_dir), *_dims(spark, sf_dir)))


@query
def dash_kpis_on_latest(spark, sf_dir):
    facts = t.ad_facts(spark, sf_dir).select(
        "ad_id", "date_start", "spend", "new_messaging_connections", "clicks", "impressions"
    )
    current = latest_version(facts, ["ad_id", "date_start"])
    return plain(dashboards.campaign_kpis(current, *_dims(spark, sf_dir)))


# --- calendar --------------------------------------------------------------------------


@query
def dim_date_spine(spark, sf_dir):
    return lifetimes.day_spine(t.ad_facts(spark, sf_dir))


@query
def dim_date_parts(spark, sf_dir):
    return dim_date(t.ad_facts(spark, sf_dir)).drop("is_holiday", "holiday_name")


@query
def dim_date_holidays(spark, sf_dir):
    return dim_date(t.ad_facts(spark, sf_dir)).select("date", "is_holiday", "holiday_name")


@query
def calendar_seasonality(spark, sf_dir):
    day = F.col("date")
    return lifetimes.day_spine(t.ad_facts(spark, sf_dir)).select(
        "date",
        calendar.social_season_factor(day).alias("social_factor"),
        calendar.search_season_factor(day).alias("search_factor"),
    )


@query
def date_arith(spark, sf_dir):
    rows = t.ad_facts(spark, sf_dir).join(t.ads(spark, sf_dir).select("ad_id", "start_date"), "ad_id")
    return rows.select(
        "ad_id",
        "date_start",
        F.date_add("start_date", F.col("clicks") * 30).alias("end_date"),
        calendar.days_active(F.col("start_date"), F.col("date_start")).alias("days_active"),
    )


@query
def day_fraction(spark, sf_dir):
    ts = F.col("ts")
    return t.table(spark, sf_dir, "events").select(
        "event_id",
        calendar.fraction_of_day(ts).alias("day_fraction"),
        calendar.run_rate(F.col("value"), ts).alias("projected_value"),
    )


@query
def window_last_n_days(spark, sf_dir):
    facts = t.ad_facts(spark, sf_dir).select("ad_id", "date_start", "spend", "clicks")
    return plain(lifetimes.last_days(facts, 20))


@query
def distinct_years(spark, sf_dir):
    return lifetimes.distinct_years(t.ad_facts(spark, sf_dir))


@query
def union_distinct_years(spark, sf_dir):
    return lifetimes.years_with_previous(t.ad_facts(spark, sf_dir))


@query
def join_active_interval(spark, sf_dir):
    ads = t.ads(spark, sf_dir)
    sets = ads.groupBy("adset_id").agg(F.min("start_date").alias("set_start"), F.max("start_date").alias("set_end"))
    length = F.substring("priority", 1, 1).cast("int") * 7
    rows = ads.select("ad_id", "adset_id", "start_date", F.date_add("start_date", length).alias("end_date"))
    with_sets = join_group_values(rows, sets, ["adset_id"])
    days = lifetimes.active_days(
        with_sets, [(F.col("set_start"), F.col("set_end")), (F.col("start_date"), F.col("end_date"))]
    )
    return days.select("ad_id", "adset_id", "date_start")


# --- breakdowns ------------------------------------------------------------------------


@query
def cross_breakdown_cells(spark, sf_dir):
    rows = t.order_totals(spark, sf_dir).select("ad_id", "date_start")
    return allocation.emit_cells(rows, allocation.DEMOGRAPHIC_CELLS, "cell")


@query
def alloc_weights(spark, sf_dir):
    targeted = {f"__{k}": v for k, v in text.audience(F.col("adset_name")).items()}
    rows = t.targeted_totals(spark, sf_dir).select("ad_id", "adset_name").withColumns(targeted)
    weights = allocation.demographic_weights(*[F.col(c) for c in targeted])
    cells = [{**cell, "weight": w} for cell, w in zip(allocation.DEMOGRAPHIC_CELLS, weights)]
    return allocation.emit_cells(rows, cells).drop("adset_name", *targeted)


@query
def alloc_normalise(spark, sf_dir):
    rows = t.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ad_id"), F.col("l_partkey").alias("creative_id"), F.col("l_quantity").alias("weight")
    )
    return allocation.normalise(rows, ["ad_id"], "weight")


@query
def alloc_demographic(spark, sf_dir):
    metrics = ["spend", "impressions", "clicks", "new_messaging_connections"]
    rows = t.targeted_totals(spark, sf_dir).select("ad_id", "date_start", "adset_name", *metrics)
    return plain(social.demographic_rows(rows, metrics=metrics).drop("adset_name"))


@query
def alloc_assets(spark, sf_dir):
    """Ad totals split over the parts the ad shows: lists of differing length, all attributes kept."""
    parts = t.table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    shown = t.table(spark, sf_dir, "lineitem").join(parts, "l_partkey")
    asset = F.struct(
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("asset_id"),
        F.col("p_name").alias("asset_name"),
        F.col("p_type").alias("asset_type"),
        F.concat_ws(" ", "p_brand", "p_name").alias("asset_text"),
    )
    assets = shown.groupBy(F.col("l_orderkey").alias("ad_id")).agg(F.array_sort(F.collect_list(asset)).alias("assets"))
    rows = t.order_totals(spark, sf_dir).select(
        "ad_id",
        F.col("spend").alias("cost"),
        "impressions",
        "clicks",
        (F.col("new_messaging_connections") * 0.375).alias("all_conversions"),
    )
    return plain(search.asset_rows(rows.join(assets, "ad_id"), "assets", F.col("ad_id").cast("string")))


@query
def alloc_keyword(spark, sf_dir):
    """Ad-group days, staged from text, split over the group's own keywords: lists of differing length."""
    keyword = F.struct(
        F.lower("p_type").alias("keyword"),
        F.when(F.min("p_partkey") % 2 == 0, "EXACT").otherwise("PHRASE").alias("match_type"),
        F.lit("ENABLED").alias("keyword_status"),
    )
    types = t.table(spark, sf_dir, "part").groupBy("p_size", "p_type").agg(keyword.alias("keyword"))
    lists = types.groupBy("p_size").agg(F.array_sort(F.collect_list("keyword")).alias("keywords"))
    owners = t.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("adgroup_id"), (F.col("s_suppkey") % 60).alias("p_size")
    )
    groups = t.search_ads(spark, sf_dir).groupBy("adgroup_id", "date_start").agg(*rollup.sums(list(rollup.SEARCH_METRICS)))
    texts = groups.withColumnRenamed("date_start", "date").select(*[F.col(c).cast("string") for c in ("adgroup_id", "date", *rollup.SEARCH_METRICS)])
    staged = search.stage(texts, "gad_keyword_performance_report").select("adgroup_id", "date_start", *rollup.SEARCH_METRICS)
    listed = staged.join(owners.join(lists, "p_size").drop("p_size"), "adgroup_id")
    seed = F.concat_ws("_", "adgroup_id", "date_start")
    return plain(search.breakdown_items(listed, "keywords", seed))


def _campaign_days(spark, sf_dir):
    totals = rollup.campaign_totals(t.search_ads(spark, sf_dir))
    return totals.withColumn("cost", F.col("cost").cast(clean.MONEY))


@query
def alloc_click_type(spark, sf_dir):
    seed = F.concat_ws("_", "campaign_id", "date_start")
    return search.click_types(_campaign_days(spark, sf_dir), seed)


@query
def union_all_breakdowns(spark, sf_dir):
    days = _campaign_days(spark, sf_dir)
    seed = F.concat_ws("_", "campaign_id", "date_start")
    ages = search.breakdown(days, [{"age_range": a} for a in allocation.SEARCH_AGES], seed)
    genders = search.breakdown(days, [{"gender": g} for g in allocation.SEARCH_GENDERS], seed)
    return plain(
        search.union_breakdowns(ages, genders).select(
            "campaign_id", "date_start", "age_range", "gender", "cost", "impressions", "clicks", "conversions"
        )
    )


# --- roll-ups --------------------------------------------------------------------------


@query
def rollup_daily_levels(spark, sf_dir):
    return plain(rollup.daily_levels(t.ad_days(spark, sf_dir)))


@query
def rollup_lifetime(spark, sf_dir):
    metrics = ["spend", "impressions", "clicks"]
    ads = t.ads(spark, sf_dir)
    length = F.substring("priority", 1, 1).cast("int") * 100
    lives = {
        "ad": ads.select("ad_id", "start_date", F.date_add("start_date", length)),
        "adset": ads.groupBy("adset_id").agg(F.min("start_date"), F.max("start_date")),
    }
    days = t.ad_facts(spark, sf_dir)
    bounds = (days.select(F.min("date_start")).scalar(), days.select(F.max("date_start")).scalar())
    totals = rollup.ad_lifetime_totals(days, metrics)
    parents = ads.join(t.adsets(spark, sf_dir), "adset_id")
    return plain(rollup.lifetime_levels(totals, parents, lives, bounds, metrics).withColumn("id", F.col("id").cast("bigint")))


@query
def rollup_recompute_ctr(spark, sf_dir):
    dirty = t.search_ads(spark, sf_dir).withColumn(
        "impressions", F.when(F.col("clicks") == 7, F.lit("--")).otherwise(F.col("impressions").cast("string"))
    )
    return plain(rollup.search_totals(dirty, ["campaign_id", "date_start"]))


@query
def daily_reports(spark, sf_dir):
    names = {
        "adset": t.adsets(spark, sf_dir).select("adset_id", "adset_name"),
        "campaign": t.campaigns(spark, sf_dir).select("campaign_id", "campaign_name"),
        "account": t.accounts(spark, sf_dir),
    }
    levels = social.level_reports(t.ad_days(spark, sf_dir), names, ["spend", "clicks"])
    return plain(levels.withColumn("id", F.col("id").cast("bigint")))


@query
def search_reports(spark, sf_dir):
    names = {
        "ad_group": t.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"),
        "campaign": t.campaigns(spark, sf_dir).select("campaign_id", "campaign_name"),
        "account": t.accounts(spark, sf_dir),
    }
    reports = search.level_reports(t.search_ads(spark, sf_dir), names)
    return plain(reports.withColumn("id", F.col("id").cast("bigint")))


@query
def rollup_campaign_totals(spark, sf_dir):
    return plain(rollup.campaign_totals(t.search_ads(spark, sf_dir)))


@query
def budget_remaining(spark, sf_dir):
    return plain(rollup.budget_remaining(t.ad_days(spark, sf_dir)))


# --- scalar functions ------------------------------------------------------------------


@query
def kpi_ratios(spark, sf_dir):
    spend, impressions, clicks = F.col("spend"), F.col("impressions"), F.col("clicks")
    messages_ = F.col("new_messaging_connections")
    return t.ad_facts(spark, sf_dir).select(
        "ad_id",
        "date_start",
        "creative_id",
        kpi.ctr_pct(clicks, impressions).alias("ctr_pct"),
        kpi.ctr_fraction(clicks, impressions).alias("ctr_fraction"),
        kpi.cpc(spend, clicks).alias("cpc"),
        kpi.cpm(spend, impressions).alias("cpm"),
        kpi.frequency(impressions, clicks).alias("frequency"),
        kpi.cost_per(spend, messages_).alias("cost_per_message"),
        kpi.ratio_floored(spend, messages_).alias("cost_floored"),
        kpi.engagement_total(clicks, messages_, clicks, F.nullif(messages_, F.lit(0)), clicks, impressions)
        .cast("bigint")
        .alias("engagements"),
    )


@query
def funnel_rates(spark, sf_dir):
    """Two chains of steps; some steps are missing, and some exceed the one before."""
    line, quantity = F.col("l_linenumber"), F.floor("l_quantity").cast("int")
    steps = {
        "video_views_p25": quantity * 8,
        "video_views_p50": quantity * 5,
        "video_views_p75": quantity * line,
        "video_views_p95": F.when(line != 6, quantity * 2),
        "video_views_p100": F.when(line < 5, quantity),
        "clicks": line * 3,
        "link_clicks": F.when(line != 2, line * 2),
        "landing_page_views": line - 1,
    }
    rows = t.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (quantity * 10).alias("impressions"), *[v.alias(k) for k, v in steps.items()]
    )
    return rows.select(F.col("l_orderkey").alias("ad_id"), F.col("l_linenumber").alias("line"), *kpi.report_funnels())


@query
def math_scalars(spark, sf_dir):
    price = F.col("l_extendedprice")
    half = (F.col("l_extendedprice").cast(clean.MONEY) / 2).cast("decimal(18,3)")
    return t.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ad_id"),
        F.col("l_linenumber").alias("line"),
        F.bround(half, 2).cast("double").alias("half_even"),
        F.floor(price * F.lit(0.015)).alias("truncated"),
        F.round(1 + F.log10(F.greatest(F.lit(1.0), price / 50000)), 6).alias("inflation"),
        F.least(F.lit(30), F.col("l_linenumber") * 5).alias("capped"),
        F.greatest(F.lit(0), F.col("l_linenumber") - 4).alias("floored"),
    )


@query
def hash_ids(spark, sf_dir):
    seed = F.concat(F.lit("seed_"), F.col("p_partkey"))
    return t.table(spark, sf_dir, "part").select(
        "p_partkey",
        text.entity_key(seed, "ad").alias("social_id"),
        text.entity_key(seed, "as", 12).alias("search_id"),
        text.numeric_key(seed).alias("numeric_id"),
        text.tagged_name(F.col("p_name"), seed).alias("tagged_name"),
    )


@query
def hash_sample(spark, sf_dir):
    key = F.concat(F.col("p_name"), F.lit("/"), F.col("p_partkey"))
    return t.table(spark, sf_dir, "part").select(
        "p_partkey",
        text.stable_bucket(key, 17).alias("bucket"),
        text.stable_pick(list(allocation.DEVICES), key).alias("device"),
        F.array_join(text.stable_sample([f"Asset {i}" for i in range(1, 21)], key, 4), ",").alias("assets"),
    )


@query
def classify_targeting(spark, sf_dir):
    rows = t.adsets(spark, sf_dir).select("adset_id", t.audience_name(F.col("segment")).alias("adset_name"))
    return rows.withColumns(text.audience(F.col("adset_name")))


@query
def age_bucket_bounds(spark, sf_dir):
    pool = [*allocation.AGES, "unknown"]
    bucket = F.element_at(F.array(*[F.lit(a) for a in pool]), (F.col("l_linenumber")))
    return t.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ad_id"), bucket.alias("age"), text.age_floor(bucket).alias("age_min")
    )


@query
def string_trim(spark, sf_dir):
    title = F.concat(F.lit("gad_"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), "p_type", F.lit("_performance_report"))
    return t.table(spark, sf_dir, "part").select("p_partkey", text.sheet_name(title).alias("sheet"))


# --- merged loads, histories, intervals, clustering --------------------------------------


def _three_loads(rows: DataFrame) -> dict[str, DataFrame]:
    """All rows; odd lines at double spend; the rows of early 1995 at triple spend, landed before the second load."""
    at = lambda text: F.lit(text).cast("timestamp")
    times = lambda n: (F.col("spend") * n).cast(clean.MONEY)
    early = F.col("date_start").between("1995-01-01", "1995-03-31")
    return {
        "load-000001": rows.withColumn("updated_at", at("2030-01-01 00:00:00")),
        "load-000002": rows.where("clicks % 2 = 1").withColumns({"spend": times(2), "updated_at": at("2030-01-02 00:00:00")}),
        "load-000003": rows.where(early).withColumns({"spend": times(3), "updated_at": at("2030-01-01 12:00:00")}),
    }


def _single_lines(spark, sf_dir) -> DataFrame:
    """One ad per line, so that no key repeats inside a load."""
    return t.ad_facts(spark, sf_dir).select(
        "date_start",
        (F.col("seg_id") % 10).cast("string").alias("account_id"),
        F.concat_ws("-", "ad_id", "clicks").alias("ad_id"),
        "spend",
        "impressions",
        "clicks",
    )


@query
def merge_on_write(spark, sf_dir):
    """The merged daily fact after three loads by month, and whether the third one left the month's files alone."""
    root, name = t.scratch(spark, "merged"), "fact_fb_ad_daily"
    months = merge.months_of(spark, root, name)
    listed = lambda: months.read().groupBy("ym").agg(F.sort_array(F.collect_set("_metadata.file_path")).alias("files"))
    for load_id, rows in _three_loads(_single_lines(spark, sf_dir)).items():
        warehouse.append(rows, root, name, load_id)
        if load_id == "load-000003":
            listed().write.parquet(f"{root}/listed")
        merge.merge_load(spark, root, name, load_id)
    before = spark.read.parquet(f"{root}/listed").withColumnRenamed("files", "before")
    kept = listed().join(before, "ym", "left").select("ym", F.col("files").eqNullSafe(F.col("before")).alias("kept"))
    merged = merge.read_merged(spark, root, name)
    sums = merged.groupBy(F.date_format("date_start", "yyyyMM").alias("ym")).agg(
        F.count(F.lit(1)).alias("records"), F.sum("spend").alias("spend"), F.sum("clicks").alias("clicks")
    )
    return plain(sums.join(kept, "ym"))


@query
def rollup_incremental(spark, sf_dir):
    """Daily level sums after three loads, each merged by its signed differences."""
    root, metrics = t.scratch(spark, "levels"), ["spend", "impressions", "clicks"]
    parents = t.parents(spark, sf_dir).select("ad_id", "adset_id", "campaign_id", "account_id")
    rows = t.ad_facts(spark, sf_dir).join(parents, "ad_id").select(
        F.concat_ws("-", "ad_id", "clicks").alias("id"),
        *[F.col(c).cast("string").alias(c) for c in ("adset_id", "campaign_id", "account_id")],
        "date_start",
        F.col("date_start").alias("date_stop"),
        "spend",
        "impressions",
        "clicks",
    )
    for load_id, load in _three_loads(rows).items():
        warehouse.append(load.drop("updated_at"), root, "fad_ad_daily_report", load_id)
        incremental.merge_load(spark, root, "fad_ad_daily_report", load_id, metrics)
    return plain(incremental.read_levels(spark, root, "fad_ad_daily_report", metrics))


def _campaign_history(spark, sf_dir) -> DataFrame:
    return history.validity(t.report(spark, sf_dir), "campaign_id", ["account_id", "campaign_name"])


@query
def dim_history(spark, sf_dir):
    """Every name a campaign had, and from which day to which."""
    return _campaign_history(spark, sf_dir)


@query
def fact_as_of_history(spark, sf_dir):
    """Daily spend of campaigns under the name each had on that day."""
    facts = t.report(spark, sf_dir).where("date_start IS NOT NULL").select("campaign_id", "date_start", "spend", "clicks")
    named = history.as_of(facts, _campaign_history(spark, sf_dir).drop("account_id"), "campaign_id")
    return plain(
        named.groupBy("date_start", "campaign_id", "campaign_name").agg(F.sum("spend").alias("spend"), F.sum("clicks").alias("clicks"))
    )


@query
def join_overlaps(spark, sf_dir):
    """Pairs of ads of one ad set that ran at the same time, and when."""
    flights = t.ads(spark, sf_dir).select(
        "ad_id", "adset_id", "start_date", F.date_add("start_date", F.substring("priority", 1, 1).cast("int") * 15).alias("end_date")
    )
    pairs = intervals.overlapping_pairs(flights, "ad_id", ["adset_id"], "start_date", "end_date", 45)
    return pairs.select("adset_id", F.col("a").alias("ad_a"), F.col("b").alias("ad_b"), "overlap_start", "overlap_end")


@query
def cluster_two_keys(spark, sf_dir):
    """Six (creative, day) boxes: their records, and whether fewer files match than under a single sort order."""
    root = t.scratch(spark, "clustered")
    facts = t.ad_facts(spark, sf_dir).select("creative_id", "date_start", "spend", "clicks")
    columns, n = ["creative_id", "date_start"], 64
    files.write_clustered(facts, f"{root}/z", columns, n)
    single = facts.repartitionByRange(n, *columns).sortWithinPartitions(*columns)
    single.write.mode("overwrite").parquet(f"{root}/single")
    most = facts.select(F.max("creative_id")).scalar()
    boxes = spark.range(6).select(
        F.col("id").cast("int").alias("box"),
        F.floor(most * F.col("id") / 6).alias("from_id"),
        F.floor(most * (F.col("id") + 1) / 6).alias("to_id"),
        F.date_add(F.lit("1995-03-01").cast("date"), F.col("id").cast("int") * 350).alias("from_day"),
        F.date_add(F.lit("1995-03-01").cast("date"), F.col("id").cast("int") * 350 + 90).alias("to_day"),
    )
    matches = []
    for layout in ("z", "single"):
        covered = files.file_boxes(spark, f"{root}/{layout}", columns)
        hit = F.col("low_creative_id") <= F.col("to_id")
        hit &= (F.col("high_creative_id") >= F.col("from_id")) & (F.col("low_date_start") <= F.col("to_day")) & (F.col("high_date_start") >= F.col("from_day"))
        # Both sides are tiny: six boxes, and one row per file.
        by_box = covered.withColumn("box", F.explode(F.sequence(F.lit(0), F.lit(5)))).join(boxes, "box").groupBy("box")
        matches.append(by_box.agg(F.count_if(hit).alias(layout)))
    stored = spark.read.schema("creative_id bigint, date_start date, clicks int").parquet(f"{root}/z")
    inside = stored.withColumn("box", F.explode(F.sequence(F.lit(0), F.lit(5)))).join(F.broadcast(boxes), "box")
    inside = inside.where("creative_id BETWEEN from_id AND to_id AND date_start BETWEEN from_day AND to_day")
    sums = inside.groupBy("box").agg(F.count(F.lit(1)).alias("records"), F.sum("clicks").alias("clicks"))
    files_matched = matches[0].join(matches[1], "box").select("box", (F.col("z") < F.col("single")).alias("fewer_files"))
    return sums.join(files_matched, "box")


@query
def reach_by_sketch(spark, sf_dir):
    """Distinct people of ads, campaigns and all, from daily sketches: the exact number, and whether the estimate is near it."""
    k = F.get_json_object("props", "$.k").cast("int")
    seen = t.table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), k.alias("ad_id"), (k % 10).alias("campaign_id"))
    levels = {"ad": F.col("ad_id"), "campaign": F.col("campaign_id"), "all": F.lit(0)}
    shown = lambda df: search.union_breakdowns(*[df.select(F.lit(n).alias("level"), c.alias("id"), df.columns[-1]) for n, c in levels.items()])
    daily = sketches.reach_sketches(seen, ["day", "ad_id", "campaign_id"], "user_id")
    found = sketches.estimated(sketches.united(shown(daily), ["level", "id"]))
    exact = shown(seen.select("ad_id", "campaign_id", "user_id")).groupBy("level", "id").agg(F.countDistinct("user_id").alias("people"))
    near = F.abs(F.col("reach") - F.col("people")) <= F.greatest(F.lit(1.0), F.col("people") * sketches.relative_error())
    return exact.join(found, ["level", "id"]).select("level", "id", "people", near.alias("within_error"))


FUNNEL, PAUSE = ["view", "click", "signup", "purchase"], 43_200


def _sessions(spark, sf_dir) -> DataFrame:
    return funnels.session_funnel(t.table(spark, sf_dir, "events"), "user_id", "ts", "event_type", FUNNEL, PAUSE)


@query
def funnel_sessions(spark, sf_dir):
    """Every session of every user (times in microseconds), and how many steps it did in their order."""
    return _sessions(spark, sf_dir).withColumns({c: F.unix_micros(c) for c in ("session_start", "session_end")})


@query
def funnel_report(spark, sf_dir):
    """Sessions that reach each step in order, by the day they begin."""
    by_day = _sessions(spark, sf_dir).withColumn("day", F.to_date("session_start"))
    return funnels.funnel_report(by_day, FUNNEL, ["day"])


# --- streaming -------------------------------------------------------------------------


def _archived(spark, sf_dir) -> DataFrame:
    base = t.scratch(spark, "stream")
    pipeline.start_archive(t.event_stream(spark, sf_dir), f"{base}/raw", f"{base}/checkpoint").awaitTermination()
    schema = "ingested_at string, raw_data string, platform string, report_type string"
    return spark.read.schema(schema).parquet(f"{base}/raw")


@query
def stream_route_counts(spark, sf_dir):
    return _archived(spark, sf_dir).groupBy("platform", "report_type").agg(F.count(F.lit(1)).alias("records"))


@query
def stream_raw_archive(spark, sf_dir):
    payload = F.from_json("raw_data", "id string, spend string, clicks string")
    return _archived(spark, sf_dir).select("*", payload.alias("d")).select(
        "platform", "report_type", "ingested_at", "d.id", clean.to_double(F.col("d.spend")).alias("spend"), clean.to_int(F.col("d.clicks")).alias("k")
    )


@query
def stream_route_facts(spark, sf_dir):
    base = t.scratch(spark, "stream")
    pipeline.run_stream(t.event_stream(spark, sf_dir), f"{base}/raw", f"{base}/warehouse", f"{base}/checkpoints")
    sub_keys = {
        "fact_fb_ad_daily": F.lit(""),
        "fact_fb_ad_creative_daily": F.col("creative_id"),
        "fact_fb_ad_demographic_daily": F.concat_ws("|", "age", "gender"),
    }
    parts = [
        warehouse.read_current(spark, f"{base}/warehouse", name).select(
            F.lit(name).alias("table_name"),
            "account_id",
            "ad_id",
            sub_key.alias("sub_key"),
            "date_start",
            "spend",
            "impressions",
            "clicks",
            "new_messaging_connections",
        )
        for name, sub_key in sub_keys.items()
    ]
    return plain(search.union_breakdowns(*parts))


@query
def stream_dims(spark, sf_dir):
    """The dimensions a stream of messages leaves behind: names and parents of the newest message of each entity."""
    base = t.scratch(spark, "stream")
    stream = t.event_stream(spark, sf_dir, named=True)
    pipeline.start_router(stream, f"{base}/warehouse", f"{base}/checkpoint").awaitTermination()
    return _entities(spark, f"{base}/warehouse", ["dim_account", "dim_campaign", "dim_adset", "dim_ad", "dim_creative"])


def _deliveries(spark, base: str) -> DataFrame:
    """Decoded messages of the parquet files in a folder, one file per micro-batch."""
    reader = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1)
    return messages.unwrap(reader.parquet(f"{base}/in"))


@query
def stream_dedup(spark, sf_dir):
    """Messages delivered twice at once, and a third time after a restart: each passes once."""
    base = t.scratch(spark, "stream")
    sent = t.event_messages(t.table(spark, sf_dir, "events"))
    sent.union(sent).coalesce(1).write.mode("append").parquet(f"{base}/in")
    for again in (True, False):
        distinct = pipeline.distinct_messages(_deliveries(spark, base), "30 days")
        pipeline.start_files(distinct, f"{base}/out", f"{base}/checkpoint").awaitTermination()
        if again:
            sent.coalesce(1).write.mode("append").parquet(f"{base}/in")
    payload = F.from_json("raw_data", "id string, spend string, clicks string")
    kept = spark.read.schema("platform string, report_type string, ingested_at string, raw_data string").parquet(f"{base}/out")
    return kept.select("platform", "report_type", "ingested_at", payload.alias("d")).select(
        "platform", "report_type", "ingested_at", "d.id", clean.to_double(F.col("d.spend")).alias("spend"), clean.to_int(F.col("d.clicks")).alias("k")
    )


@query
def stream_windows(spark, sf_dir):
    """Daily sums of the message stream by event time; the days the watermark has closed."""
    base = t.scratch(spark, "stream")
    sums = pipeline.windowed_sums(t.event_stream(spark, sf_dir), "1 day", "2 days")
    pipeline.start_files(sums, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    shape = "window_start timestamp, platform string, report_type string, records bigint, spend decimal(28,2), clicks bigint"
    found = spark.read.schema(shape).parquet(f"{base}/out")
    return plain(found.select(F.to_date("window_start").alias("date_start"), "platform", "report_type", "records", "spend", "clicks"))
