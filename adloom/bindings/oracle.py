"""The same results in DuckDB SQL, written independently of the Spark plans."""

from __future__ import annotations

# Fixed values of the feeds, stated here anew so that a wrong constant in the library shows.
CLICK_TYPES = ("URL_CLICKS", "AD_IMAGE", "HEADLINE", "SITELINKS", "CALLS")
SEARCH_AGES = tuple(f"AGE_RANGE_{a}" for a in ("18_24", "25_34", "35_44", "45_54", "55_64", "65_UP", "UNDETERMINED"))
SEARCH_GENDERS = ("MALE", "FEMALE", "UNDETERMINED")

FACTS = """
f AS (
  SELECT CAST(l_shipdate AS DATE) AS date_start, l_orderkey AS ad_id, l_partkey AS creative_id, l_suppkey AS seg_id,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS spend, CAST(floor(l_quantity) AS INTEGER) AS impressions,
         l_linenumber AS clicks, CASE WHEN l_returnflag = 'N' THEN 'unknown' ELSE l_returnflag END AS gender,
         l_linestatus AS age, l_linenumber - 1 AS messages
  FROM lineitem
)"""

CAMPAIGN_OF_AD = """
p AS (
  SELECT o_orderkey AS ad_id, o_custkey AS adset_id, c_nationkey AS campaign_id, n_regionkey AS account_id,
         n_name AS campaign_name, CAST(c_acctbal AS DECIMAL(18,2)) AS daily_budget
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

REPORT = """
r AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS account_id,
         CASE WHEN o_orderstatus <> 'P' THEN r_name || ' ' || o_orderstatus END AS account_name,
         CAST(n_nationkey AS VARCHAR) AS campaign_id, n_name || ' / ' || c_mktsegment AS campaign_name,
         CAST(o_custkey AS VARCHAR) AS adset_id, c_name || ' ' || o_orderpriority AS adset_name,
         CAST(l_orderkey AS VARCHAR) AS id,
         CASE WHEN l_linenumber > 1 THEN 'Ad ' || l_orderkey || '-' || l_linenumber END AS name,
         CAST(l_shipdate AS DATE) AS date_start,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
         CASE WHEN l_tax > 0 THEN CAST(l_partkey AS VARCHAR) END AS creative_id,
         'Creative ' || l_suppkey AS creative_name, l_linestatus AS age,
         CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS gender,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS spend,
         CAST(trunc(l_quantity * 100) AS INTEGER) AS impressions, CAST(trunc(l_quantity * 95) AS INTEGER) AS reach,
         l_linenumber * 3 AS clicks, CASE WHEN l_returnflag <> 'R' THEN l_linenumber % 3 END AS messages,
         l_linenumber * 2 AS link_clicks, l_linenumber AS landing_page_views, CAST(l_suppkey AS INTEGER) AS post_reactions
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

LANDED = """
landed AS (
  SELECT * REPLACE (spend * 2 AS spend), 1 AS landing FROM r WHERE clicks % 2 = 1
  UNION ALL SELECT *, 2 FROM r WHERE clicks <> 21
)"""

SEARCH = """
g AS (
  SELECT l_suppkey AS adgroup_id, s_nationkey AS campaign_id, CAST(l_shipdate AS DATE) AS date_start,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS cost, CAST(floor(l_quantity) AS BIGINT) * 10 AS impressions,
         CAST(l_linenumber AS BIGINT) AS clicks, CAST(round(l_discount * 100) AS DOUBLE) * 0.375::DOUBLE AS all_conversions
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
)"""

ORDER_TOTALS = """
o AS (
  SELECT o_orderkey AS ad_id, CAST(o_orderdate AS DATE) AS date_start, CAST(o_totalprice AS DECIMAL(18,2)) AS spend,
         o_custkey * 7 + 11 AS impressions, o_custkey % 97 AS clicks, o_orderkey % 31 AS messages,
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Phụ nữ 18-24' WHEN 'MACHINERY' THEN 'Xe & Nam giới'
           WHEN 'BUILDING' THEN 'Nhóm Quản lý, CEO' WHEN 'FURNITURE' THEN 'Sinh viên 18-24'
           ELSE 'Mọi người' END AS adset_name
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

AUDIENCE = """
  CASE WHEN contains(adset_name, 'Phụ nữ') THEN 'female' WHEN contains(adset_name, 'Nam giới') THEN 'male' END AS gender,
  CASE WHEN contains(adset_name, 'CEO') OR contains(adset_name, 'Quản lý') THEN 35 WHEN contains(adset_name, '18-24') THEN 18 END AS age_min,
  CASE WHEN contains(adset_name, 'CEO') OR contains(adset_name, 'Quản lý') THEN 65 WHEN contains(adset_name, '18-24') THEN 24 END AS age_max"""

CELLS = """
cells AS (
  SELECT (a.i - 1) * 2 + s.i AS cell, a.age, a.low, a.base, s.gender
  FROM (VALUES (1,'18-24',18,20000),(2,'25-34',25,60000),(3,'35-44',35,60000),(4,'45-54',45,20000),
               (5,'55-64',55,20000),(6,'65+',65,6000)) a(i, age, low, base)
  CROSS JOIN (VALUES (1,'female'),(2,'male')) s(i, gender)
)"""

WEIGHTED = f"""{ORDER_TOTALS}, w AS (
  SELECT o.*, {AUDIENCE} FROM o
), {CELLS}, c AS (
  SELECT w.* EXCLUDE (gender), cells.cell, cells.age, cells.gender,
         CAST(cells.base / (CASE WHEN cells.low < w.age_min OR cells.low > w.age_max THEN 20 ELSE 1 END)
                         / (CASE WHEN w.gender <> cells.gender THEN 100 ELSE 1 END) AS BIGINT) AS weight
  FROM w CROSS JOIN cells
)"""


def hash_number(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def in_season(day: str, low: int, high: int) -> str:
    return f"(month({day}) * 100 + day({day}) BETWEEN {low} AND {high})"


def newest(key: str, columns: dict[str, str], where: str = "TRUE", source: str = "r", landing: str = "0") -> str:
    """Per key the attributes of its newest day, ties to the later landing, then to the greatest attribute values."""
    select = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    order = ", ".join(f"{name} DESC NULLS LAST" for name in columns)
    names = ", ".join(columns)
    own = "" if source == "r" else f", {LANDED}"
    return f"""WITH {REPORT}{own}, rows AS (SELECT {key}, date_start, {landing} AS landing, {select} FROM {source} WHERE {where})
SELECT {key.split(' AS ')[-1]}, {names} FROM rows
QUALIFY row_number() OVER (PARTITION BY {key.split(' AS ')[-1]} ORDER BY date_start DESC, landing DESC, {order}) = 1"""


def parts(metric: str, cells: str, money: bool = False) -> str:
    """A leading cell's part, and the remainder for the last cell; per row ``id``."""
    total = f"CAST({metric} * 100 AS BIGINT)" if money else metric
    rounded = "round_even({}, 0)" if money else "floor({})"
    part = f"CAST({rounded.format(f'(CAST({total} AS DOUBLE) * weight) / den')} AS BIGINT)"
    value = (
        f"CASE WHEN cell = {cells} THEN {total} - sum(CASE WHEN cell < {cells} THEN {part} ELSE 0 END) "
        f"OVER (PARTITION BY row_id) ELSE {part} END"
    )
    scaled = f"CAST(CAST(({value}) AS DECIMAL(18,0)) * 0.01 AS DOUBLE)" if money else f"CAST({value} AS BIGINT)"
    return f"{scaled} AS {metric}"


def fraction_parts(metric: str, cells: str) -> str:
    """The same for a fraction: exact parts, taken off one after the other in cell order, the rest last."""
    part = f"({metric} * weight) / den"
    listed = f"list({part} ORDER BY cell) OVER (PARTITION BY row_id)"
    taken = f"list_reduce(list_prepend({metric}, list_slice({listed}, 1, CAST({cells} - 1 AS BIGINT))), lambda x, y: x - y)"
    return f"CASE WHEN cell = {cells} THEN {taken} ELSE {part} END AS {metric}"


def share_split(rows: str, seed: str, values: list[str]) -> str:
    """Rows crossed with a value list, each cell with its stable weight."""
    listed = ", ".join(f"({i + 1}, '{v}')" for i, v in enumerate(values))
    return f"""SELECT x.*, v.cell, v.item, 500 + {hash_number(f"{seed} || '_' || CAST(v.cell - 1 AS VARCHAR)")} % 1001 AS weight,
      {1000 * len(values)}.0::DOUBLE AS den
    FROM {rows} x CROSS JOIN (VALUES {listed}) v(cell, item)"""


EVENT_ROWS = "SELECT event_id, user_id, event_type AS report_type, value AS spend, props AS raw_data FROM events"

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

MESSAGES = f"""
m AS (
  SELECT CASE event_type WHEN 'error' THEN 'google' ELSE 'facebook' END AS platform,
         CASE event_type WHEN 'purchase' THEN 'ad_creative' WHEN 'view' THEN 'age_gender' WHEN 'signup' THEN 'ad_set_daily'
           ELSE 'ad_daily' END AS report_type,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ingested_at, CAST(user_id AS VARCHAR) AS id,
         CAST(user_id % 10 AS VARCHAR) AS account_id, CAST(ts AS DATE) AS date_start, value AS spend, {K} AS k
  FROM events
)"""


def routed_fact(table: str, report_type: str, sub_key: str) -> str:
    return f"""
  SELECT '{table}' AS table_name, account_id, id AS ad_id, {sub_key} AS sub_key, date_start, spend, k * 10 AS impressions,
         k AS clicks, k AS new_messaging_connections
  FROM m WHERE platform = 'facebook' AND report_type = '{report_type}'
  QUALIFY row_number() OVER (PARTITION BY account_id, id, date_start, {sub_key} ORDER BY ingested_at DESC, k DESC, spend DESC) = 1"""


def current(table: str, keys: str, where: str = "TRUE") -> str:
    return f"""
  SELECT '{table}' AS table_name, account_id, CAST(count(*) AS BIGINT) AS records,
         CAST(sum(spend) AS DOUBLE) AS spend, CAST(sum(clicks) AS BIGINT) AS clicks
  FROM (SELECT * FROM landed WHERE {where}
        QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY landing DESC, spend DESC, impressions DESC, reach DESC, clicks DESC) = 1)
  GROUP BY account_id"""


ORACLE: dict[str, str] = {
    "scan_json_lake": EVENT_ROWS,
    "scan_json_lines": EVENT_ROWS,
    "scan_missing_table": EVENT_ROWS,
    "sink_json_partitioned": """
SELECT strftime(date_trunc('day', ts) + INTERVAL 26 HOUR, '%Y/%m/%d/%H/%M') AS landing_path,
       CAST(count(*) AS BIGINT) AS records, CAST(sum(event_id) AS BIGINT) AS id_sum
FROM events GROUP BY 1""",
    "row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS records FROM {name}"
        for name in ("lineitem", "orders", "customer", "nation", "region", "events")
    ),
    "fact_month_partition": f"""WITH {FACTS}
SELECT strftime(date_start, '%Y%m') AS ym, CAST(count(*) AS BIGINT) AS records, CAST(sum(spend) AS DOUBLE) AS spend,
       CAST(sum(clicks) AS BIGINT) AS clicks FROM f GROUP BY 1""",
    "project_rename": """
SELECT l_orderkey AS id, l_partkey AS adset_id, coalesce(CASE WHEN l_returnflag <> 'R' THEN l_linenumber END, l_linenumber * 10) AS link_clicks,
       l_suppkey AS new_messaging_connections, l_quantity AS video_views_p25, l_tax AS cost_per_thru_play, l_discount AS cost_leads
FROM lineitem""",
    "project_defaults": """
SELECT l_orderkey AS ad_id, CASE WHEN l_returnflag = 'R' THEN 'Unknown' ELSE l_returnflag END AS account_name,
       CASE WHEN l_tax > 0 THEN l_linenumber ELSE 0 END AS clicks,
       CASE WHEN l_discount > 0 THEN l_extendedprice ELSE 0.0::DOUBLE END AS spend,
       'ACTIVE' AS status, 0.0::DOUBLE AS ctr, '' AS page_name
FROM lineitem""",
    "cast_tolerant": """
WITH d AS (
  SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'n/a' WHEN 1 THEN '' WHEN 2 THEN '12.7' WHEN 3 THEN '-3.9'
    WHEN 4 THEN '  ' || CAST(value AS VARCHAR) || ' ' WHEN 5 THEN '99999999999' WHEN 6 THEN '1e3' ELSE CAST(value AS VARCHAR) END AS x
  FROM events
)
SELECT event_id, TRY_CAST(trunc(TRY_CAST(x AS DOUBLE)) AS INTEGER) AS as_int, TRY_CAST(x AS DOUBLE) AS as_double,
       CAST(TRY_CAST(x AS DECIMAL(18,2)) AS DOUBLE) AS as_money, coalesce(TRY_CAST(x AS DOUBLE), 0) AS or_zero
FROM d""",
    "filter_valid": """
SELECT l_orderkey AS id, CAST(l_shipdate AS DATE) AS date_start, l_returnflag AS age, l_linenumber AS clicks
FROM lineitem WHERE l_tax > 0 AND l_discount > 0 AND l_returnflag <> 'N'""",
    "parse_dates": """
SELECT event_id, CAST(try_strptime(CASE event_id % 5 WHEN 0 THEN 'not a day' WHEN 1 THEN '2024-02-30' WHEN 2 THEN ''
  ELSE strftime(ts, '%Y-%m-%d') END, '%Y-%m-%d') AS DATE) AS date_start
FROM events""",
    "parse_timestamps": """
SELECT event_id, CAST(CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN floor(epoch(ts)) - 25200 WHEN 2 THEN floor(epoch(ts)) + 12600
  ELSE floor(epoch(ts)) END AS BIGINT) AS created_epoch
FROM events""",
    "json_envelope": f"WITH {MESSAGES} SELECT platform, report_type, ingested_at, id, spend, k FROM m",
    "json_roundtrip": "SELECT event_id, user_id, event_type, value FROM events",
    "dim_account": newest("account_id", {"account_name": "coalesce(account_name, 'Unknown')"}),
    "dim_campaign": newest("campaign_id", {"account_id": "account_id", "campaign_name": "campaign_name"}),
    "dim_adset": newest("adset_id", {"campaign_id": "campaign_id", "adset_name": "adset_name"}),
    "dim_ad": newest(
        "id AS ad_id",
        {
            "adset_id": "adset_id",
            "ad_name": "coalesce(name, 'Unknown')",
            "status": "coalesce(status, 'UNKNOWN')",
            "effective_status": "'UNKNOWN'",
        },
    ),
    "dim_creative": newest(
        "creative_id",
        {
            "creative_title": "creative_name",
            "creative_body": "''",
            "creative_thumbnail_raw_url": "''",
            "creative_link": "''",
            "page_name": "'Unknown'",
        },
        "creative_id IS NOT NULL",
    ),
    "fact_ad_daily": f"""WITH {REPORT}
SELECT date_start, account_id, id AS ad_id, CAST(spend AS DOUBLE) AS spend, impressions, reach, clicks,
       coalesce(CAST(clicks AS DOUBLE) / nullif(impressions, 0) * 100, 0) AS ctr,
       coalesce(CAST(spend AS DOUBLE) / nullif(clicks, 0), 0) AS cpc,
       coalesce(CAST(spend * 1000 AS DOUBLE) / nullif(impressions, 0), 0) AS cpm,
       coalesce(CAST(impressions AS DOUBLE) / nullif(reach, 0), 0) AS frequency,
       coalesce(messages, 0) AS new_messaging_connections,
       coalesce(CAST(spend AS DOUBLE) / nullif(messages, 0), 0) AS cost_per_new_messaging,
       link_clicks, landing_page_views
FROM r""",
    "fact_creative_daily": f"""WITH {REPORT}
SELECT date_start, account_id, id AS ad_id, creative_id, CAST(spend AS DOUBLE) AS spend, impressions, reach, clicks,
       coalesce(messages, 0) AS new_messaging_connections, 0 AS post_engagements, post_reactions, 0 AS post_shares, 0 AS photo_views
FROM r WHERE creative_id IS NOT NULL""",
    "fact_demographic_daily": f"""WITH {REPORT}
SELECT date_start, account_id, id AS ad_id, age, coalesce(gender, 'unknown') AS gender, CAST(spend AS DOUBLE) AS spend,
       impressions, reach, clicks, link_clicks AS inline_link_clicks, coalesce(messages, 0) AS new_messaging_connections
FROM r""",
    "flat_report": f"""WITH {REPORT}
SELECT id, coalesce(name, '') AS name, adset_id, adset_name, campaign_id, campaign_name, account_id,
       coalesce(account_name, '') AS account_name, date_start, date_start AS date_stop, CAST(spend AS DOUBLE) AS spend,
       impressions, reach, clicks, 0 AS messaging_first_reply, coalesce(messages, 0) AS new_messaging_connections,
       0 AS post_comments, link_clicks, landing_page_views, 0 AS page_likes, 0 AS thru_play
FROM r""",
    "latest_version": """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS l_shipdate, l_partkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY CAST(l_shipdate AS DATE) DESC, l_partkey DESC, l_extendedprice DESC) = 1""",
    "batch_lake_to_star": f"WITH {REPORT}, {LANDED}"
    + " UNION ALL ".join(
        (
            current("fact_fb_ad_daily", "account_id, id, date_start"),
            current(
                "fact_fb_ad_creative_daily", "account_id, id, creative_id, date_start", "creative_id IS NOT NULL"
            ),
            current("fact_fb_ad_demographic_daily", "account_id, id, age, coalesce(gender, 'unknown'), date_start"),
        )
    ),
    "batch_flat_report": f"""WITH {REPORT}, {LANDED}
SELECT id, account_id, date_start, CAST(spend AS DOUBLE) AS spend, impressions, reach, clicks, link_clicks FROM landed
QUALIFY row_number() OVER (PARTITION BY account_id, id, date_start
  ORDER BY landing DESC, coalesce(name, '') DESC, spend DESC, impressions DESC, reach DESC, clicks DESC) = 1""",
    "batch_dims": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {key} AS key, {parent} AS parent, {name} AS name, {status} AS status FROM ({rows})"
        for table, key, parent, name, status, rows in (
            ("dim_account", "account_id", "NULL::VARCHAR", "account_name", "NULL::VARCHAR",
             newest("account_id", {"account_name": "coalesce(account_name, 'Unknown')"}, source="landed", landing="landing")),
            ("dim_campaign", "campaign_id", "account_id", "campaign_name", "NULL::VARCHAR",
             newest("campaign_id", {"account_id": "account_id", "campaign_name": "campaign_name"}, source="landed", landing="landing")),
            ("dim_adset", "adset_id", "campaign_id", "adset_name", "NULL::VARCHAR",
             newest("adset_id", {"campaign_id": "campaign_id", "adset_name": "adset_name"}, source="landed", landing="landing")),
            ("dim_ad", "ad_id", "adset_id", "ad_name", "status",
             newest("id AS ad_id", {"adset_id": "adset_id", "ad_name": "coalesce(name, 'Unknown')", "status": "'ACTIVE'"}, source="landed", landing="landing")),
            ("dim_creative", "creative_id", "NULL::VARCHAR", "creative_title", "'Unknown'",
             newest("creative_id", {"creative_title": "creative_name"}, "creative_id IS NOT NULL", source="landed", landing="landing")),
        )
    ),
    "dash_spend_by_campaign_day": f"""WITH {FACTS}, {CAMPAIGN_OF_AD}
SELECT campaign_name, date_start, CAST(sum(spend) AS DOUBLE) AS total_spend FROM f JOIN p USING (ad_id) GROUP BY 1, 2""",
    "dash_campaign_kpis": f"""WITH {FACTS}, {CAMPAIGN_OF_AD}
SELECT date_start, campaign_name, CAST(sum(spend) AS DOUBLE) AS total_spend, CAST(sum(messages) AS BIGINT) AS total_messaging,
       CAST(sum(clicks) AS BIGINT) AS total_clicks, CAST(sum(impressions) AS BIGINT) AS total_impressions,
       CASE WHEN sum(messages) > 0 THEN CAST(sum(spend) AS DOUBLE) / sum(messages) ELSE 0 END AS cost_per_message,
       CAST(sum(clicks) AS DOUBLE) / nullif(sum(impressions), 0) * 100 AS ctr,
       CAST(sum(messages) AS DOUBLE) / nullif(sum(clicks), 0) * 100 AS cpm
FROM f JOIN p USING (ad_id) GROUP BY 1, 2 ORDER BY 1""",
    "dash_demographic": f"""WITH {FACTS}, {CAMPAIGN_OF_AD}
SELECT campaign_name, age, gender, CAST(sum(spend) AS DOUBLE) AS total_spend, CAST(sum(messages) AS BIGINT) AS total_messaging,
       CAST(sum(impressions) AS BIGINT) AS total_impressions
FROM f JOIN p USING (ad_id) WHERE gender <> 'unknown' GROUP BY 1, 2, 3 ORDER BY 4 DESC""",
    "dash_kpis_on_latest": f"""WITH {FACTS}, {CAMPAIGN_OF_AD}, l AS (
  SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY ad_id, date_start
    ORDER BY spend DESC, messages DESC, clicks DESC, impressions DESC) = 1
)
SELECT date_start, campaign_name, CAST(sum(spend) AS DOUBLE) AS total_spend, CAST(sum(messages) AS BIGINT) AS total_messaging,
       CAST(sum(clicks) AS BIGINT) AS total_clicks, CAST(sum(impressions) AS BIGINT) AS total_impressions,
       CASE WHEN sum(messages) > 0 THEN CAST(sum(spend) AS DOUBLE) / sum(messages) ELSE 0 END AS cost_per_message,
       CAST(sum(clicks) AS DOUBLE) / nullif(sum(impressions), 0) * 100 AS ctr,
       CAST(sum(messages) AS DOUBLE) / nullif(sum(clicks), 0) * 100 AS cpm
FROM l JOIN p USING (ad_id) GROUP BY 1, 2 ORDER BY 1""",
}

SPINE = """
s AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem)
)"""

HOLIDAY = f"""CASE WHEN {in_season('date', 101, 101)} THEN 'Tết Dương Lịch' WHEN {in_season('date', 115, 205)} THEN 'Tết Nguyên Đán'
  WHEN {in_season('date', 430, 430)} THEN 'Ngày Giải Phóng Miền Nam' WHEN {in_season('date', 501, 501)} THEN 'Ngày Quốc Tế Lao Động'
  WHEN {in_season('date', 902, 902)} THEN 'Quốc Khánh' END"""

ORACLE |= {
    "dim_date_spine": f"WITH {SPINE} SELECT date FROM s",
    "dim_date_parts": f"""WITH {SPINE}
SELECT date, CAST(year(date) AS SMALLINT) AS year, CAST(quarter(date) AS TINYINT) AS quarter, CAST(month(date) AS TINYINT) AS month,
       monthname(date) AS month_name, CAST(week(date) AS TINYINT) AS week, CAST(dayofyear(date) AS SMALLINT) AS day_of_year,
       CAST(day(date) AS TINYINT) AS day_of_month, CAST(isodow(date) AS TINYINT) AS day_of_week, dayname(date) AS day_name,
       CAST(isodow(date) >= 6 AS TINYINT) AS is_weekend FROM s""",
    "dim_date_holidays": f"""WITH {SPINE}, h AS (SELECT date, {HOLIDAY} AS holiday_name FROM s)
SELECT date, CAST(holiday_name IS NOT NULL AS TINYINT) AS is_holiday, holiday_name FROM h""",
    "calendar_seasonality": f"""WITH {SPINE}
SELECT date, (CASE WHEN isodow(date) >= 5 THEN 1.4::DOUBLE ELSE 1.0::DOUBLE END)
         * (CASE WHEN {in_season('date', 115, 205)} THEN 1.8::DOUBLE ELSE 1.0::DOUBLE END) AS social_factor,
       (CASE WHEN isodow(date) >= 6 THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END)
         * (CASE WHEN {in_season('date', 210, 214)} THEN 2.5::DOUBLE ELSE 1.0::DOUBLE END)
         * (CASE WHEN {in_season('date', 305, 308)} THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END) AS search_factor
FROM s""",
    "date_arith": f"""WITH {FACTS}
SELECT ad_id, date_start, CAST(CAST(o_orderdate AS DATE) + clicks * 30 AS DATE) AS end_date,
       CAST(greatest(0, date_diff('day', CAST(o_orderdate AS DATE), date_start)) AS INTEGER) AS days_active
FROM f JOIN orders ON ad_id = o_orderkey""",
    "day_fraction": """
WITH d AS (SELECT event_id, value, (hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 86400.0::DOUBLE AS day_fraction FROM events)
SELECT event_id, day_fraction, value / nullif(day_fraction, 0) AS projected_value FROM d""",
    "window_last_n_days": f"""WITH {FACTS}
SELECT ad_id, date_start, CAST(spend AS DOUBLE) AS spend, clicks FROM f
WHERE date_start BETWEEN (SELECT max(date_start) FROM f) - 20 AND (SELECT max(date_start) FROM f)""",
    "distinct_years": "SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem ORDER BY 1",
    "union_distinct_years": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem UNION SELECT CAST(year(l_shipdate) - 1 AS INTEGER) FROM lineitem ORDER BY 1""",
    "join_active_interval": f"""WITH {SPINE.replace('l_shipdate', 'o_orderdate').replace('lineitem', 'orders').replace('AS hi', '+ 60 AS hi')}, a AS (
  SELECT o_orderkey AS ad_id, o_custkey AS adset_id, CAST(o_orderdate AS DATE) AS start_date,
         CAST(o_orderdate AS DATE) + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 7 AS end_date FROM orders
), sets AS (
  SELECT adset_id, min(start_date) AS set_start, max(start_date) AS set_end FROM a GROUP BY 1
)
SELECT ad_id, adset_id, date AS date_start FROM a JOIN sets USING (adset_id)
JOIN s ON date BETWEEN start_date AND end_date AND date BETWEEN set_start AND set_end""",
    "cross_breakdown_cells": f"""WITH {CELLS}
SELECT o_orderkey AS ad_id, CAST(o_orderdate AS DATE) AS date_start, CAST(cell AS INTEGER) AS cell, age, gender FROM orders CROSS JOIN cells""",
    "alloc_weights": f"WITH {WEIGHTED} SELECT ad_id, age, gender, weight FROM c",
    "alloc_normalise": """
SELECT l_orderkey AS ad_id, l_partkey AS creative_id, l_quantity AS weight,
       l_quantity / greatest(0.0001::DOUBLE, sum(l_quantity) OVER (PARTITION BY l_orderkey)) AS share FROM lineitem""",
    "alloc_demographic": f"""WITH {WEIGHTED}, d AS (
  SELECT *, ad_id AS row_id, messages AS new_messaging_connections,
         greatest(0.0001::DOUBLE, CAST(sum(weight) OVER (PARTITION BY ad_id) AS DOUBLE)) AS den FROM c
)
SELECT ad_id, date_start, age, gender, {parts('spend', '12', money=True)}, {parts('impressions', '12')}, {parts('clicks', '12')},
       {parts('new_messaging_connections', '12')} FROM d""",
    "alloc_assets": f"""WITH {ORDER_TOTALS}, a AS (
  SELECT ad_id, ad_id AS row_id, spend AS cost, impressions, clicks, messages * 0.375::DOUBLE AS all_conversions, l_linenumber AS line,
         l_partkey AS asset_id, p_name AS asset_name, p_type AS asset_type, p_brand || ' ' || p_name AS asset_text,
         row_number() OVER (PARTITION BY ad_id ORDER BY l_linenumber, l_partkey) AS cell, count(*) OVER (PARTITION BY ad_id) AS n
  FROM o JOIN lineitem ON ad_id = l_orderkey JOIN part ON l_partkey = p_partkey
), d AS (
  SELECT *, 500 + {hash_number("CAST(ad_id AS VARCHAR) || '_' || CAST(cell - 1 AS VARCHAR)")} % 1001 AS weight, CAST(1000 * n AS DOUBLE) AS den FROM a
), e AS (
  SELECT ad_id, line, asset_id, asset_name, asset_type, asset_text, {parts('cost', 'n', money=True)}, {parts('impressions', 'n')},
         {parts('clicks', 'n')}, {fraction_parts('all_conversions', 'n')} FROM d
)
SELECT *, clicks / greatest(1.0::DOUBLE, CAST(impressions AS DOUBLE)) AS ctr_fraction FROM e""",
    "alloc_keyword": f"""WITH {SEARCH}, k AS (
  SELECT p_size, lower(p_type) AS keyword, CASE WHEN min(p_partkey) % 2 = 0 THEN 'EXACT' ELSE 'PHRASE' END AS match_type
  FROM part GROUP BY p_size, p_type
), x AS (
  SELECT CAST(adgroup_id AS VARCHAR) AS adgroup_id, adgroup_id % 60 AS p_size, date_start, CAST(sum(cost) AS DECIMAL(18,2)) AS cost,
         CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks,
         CAST(sum(all_conversions) AS DOUBLE) AS all_conversions,
         CAST(adgroup_id AS VARCHAR) || '_' || CAST(date_start AS VARCHAR) AS row_id
  FROM g GROUP BY g.adgroup_id, date_start
), c AS (
  SELECT x.*, keyword, match_type, row_number() OVER (PARTITION BY row_id ORDER BY keyword, match_type) AS cell,
         count(*) OVER (PARTITION BY row_id) AS n FROM x JOIN k USING (p_size)
), d AS (
  SELECT *, 500 + {hash_number("row_id || '_' || CAST(cell - 1 AS VARCHAR)")} % 1001 AS weight, CAST(1000 * n AS DOUBLE) AS den FROM c
), e AS (
  SELECT adgroup_id, date_start, keyword, match_type, 'ENABLED' AS keyword_status, {parts('cost', 'n', money=True)}, {parts('impressions', 'n')},
         {parts('clicks', 'n')}, {fraction_parts('all_conversions', 'n')} FROM d
), z AS (SELECT *, CAST(floor(CAST(all_conversions AS DOUBLE) * 0.8::DOUBLE) AS BIGINT) AS conversions FROM e)
SELECT *, clicks / greatest(1.0::DOUBLE, CAST(impressions AS DOUBLE)) AS ctr_fraction,
       cost / greatest(1.0::DOUBLE, CAST(clicks AS DOUBLE)) AS average_cpc,
       cost / greatest(1.0::DOUBLE, CAST(conversions AS DOUBLE)) AS cost_per_conversion FROM z""",
    "alloc_click_type": f"""WITH {SEARCH}, x AS (
  SELECT campaign_id, date_start, CAST(sum(cost) AS DOUBLE) AS cost, CAST(sum(impressions) AS DOUBLE) AS impressions,
         CAST(sum(clicks) AS DOUBLE) AS clicks, CAST(sum(all_conversions) AS DOUBLE) AS all_conversions,
         CAST(campaign_id AS VARCHAR) || '_' || CAST(date_start AS VARCHAR) AS row_id
  FROM g GROUP BY campaign_id, date_start
), d AS ({share_split('x', 'x.row_id', list(CLICK_TYPES))}), e AS (SELECT *, weight / den AS share FROM d)
SELECT campaign_id, date_start, item AS click_type, CAST(floor(cost * share) AS BIGINT) AS cost,
       CAST(floor(impressions * share) AS BIGINT) AS impressions, CAST(floor(clicks * share) AS BIGINT) AS clicks,
       clicks * share / greatest(1.0::DOUBLE, impressions * share) AS ctr_fraction,
       CAST(floor(all_conversions * share * 0.8::DOUBLE) AS BIGINT) AS conversions, all_conversions * share AS all_conversions
FROM e""",
}


ORACLE["batch_dims"] += f""" UNION ALL SELECT 'dim_date', CAST(date AS VARCHAR), CAST(year(date) AS VARCHAR), dayname(date), {HOLIDAY}
FROM (WITH {SPINE} SELECT date FROM s)"""


def _breakdown(items: tuple[str, ...], age: str, gender: str) -> str:
    last = str(len(items))
    return f"""SELECT campaign_id, date_start, {age} AS age_range, {gender} AS gender, {parts('cost', last, money=True)},
  {parts('impressions', last)}, {parts('clicks', last)}, {fraction_parts('all_conversions', last)}
FROM ({share_split('x', 'x.row_id', list(items))})"""


ORACLE |= {
    "union_all_breakdowns": f"""WITH {SEARCH}, x AS (
  SELECT campaign_id, date_start, CAST(sum(cost) AS DECIMAL(18,2)) AS cost, CAST(sum(impressions) AS BIGINT) AS impressions,
         CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(all_conversions) AS DOUBLE) AS all_conversions,
         CAST(campaign_id AS VARCHAR) || '_' || CAST(date_start AS VARCHAR) AS row_id
  FROM g GROUP BY campaign_id, date_start
), u AS (
  {_breakdown(SEARCH_AGES, 'item', 'CAST(NULL AS VARCHAR)')}
  UNION ALL
  {_breakdown(SEARCH_GENDERS, 'CAST(NULL AS VARCHAR)', 'item')}
)
SELECT campaign_id, date_start, age_range, gender, cost, impressions, clicks,
       CAST(floor(CAST(all_conversions AS DOUBLE) * 0.8::DOUBLE) AS BIGINT) AS conversions FROM u""",
    "rollup_daily_levels": f"""WITH {FACTS}, {CAMPAIGN_OF_AD}
SELECT date_start, CASE WHEN grouping(adset_id) = 0 THEN 'adset' WHEN grouping(campaign_id) = 0 THEN 'campaign' ELSE 'account' END AS level,
       CAST(CASE WHEN grouping(adset_id) = 0 THEN adset_id WHEN grouping(campaign_id) = 0 THEN campaign_id ELSE account_id END AS BIGINT) AS id,
       CAST(sum(spend) AS DOUBLE) AS spend, CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks,
       CAST(sum(messages) AS BIGINT) AS new_messaging_connections
FROM f JOIN p USING (ad_id)
GROUP BY GROUPING SETS ((date_start, adset_id), (date_start, campaign_id), (date_start, account_id))""",
    "rollup_lifetime": f"""WITH {FACTS}, {CAMPAIGN_OF_AD}, a AS (
  SELECT o_orderkey AS ad_id, o_custkey AS adset_id, CAST(o_orderdate AS DATE) AS start_date,
         CAST(o_orderdate AS DATE) + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 100 AS end_date FROM orders
), sets AS (
  SELECT adset_id, min(start_date) AS start_date, max(start_date) AS end_date FROM a GROUP BY 1
), j AS (SELECT * FROM f JOIN p USING (ad_id)), b AS (SELECT min(date_start) AS lo, max(date_start) AS hi FROM f), u AS (
  SELECT 'ad' AS level, ad_id AS id, any_value(start_date) AS date_start, any_value(end_date) AS date_stop, sum(spend) AS spend,
         sum(impressions) AS impressions, sum(clicks) AS clicks FROM j JOIN a USING (ad_id) GROUP BY ad_id
  UNION ALL
  SELECT 'adset', adset_id, any_value(start_date), any_value(end_date), sum(spend), sum(impressions), sum(clicks)
  FROM j JOIN sets USING (adset_id) GROUP BY adset_id
  UNION ALL
  SELECT 'campaign', campaign_id, (SELECT lo FROM b), (SELECT hi FROM b), sum(spend), sum(impressions), sum(clicks) FROM j GROUP BY campaign_id
)
SELECT level, CAST(id AS BIGINT) AS id, date_start, date_stop, CAST(spend AS DOUBLE) AS spend, CAST(impressions AS BIGINT) AS impressions,
       CAST(clicks AS BIGINT) AS clicks FROM u""",
    "rollup_recompute_ctr": f"""WITH {SEARCH}, d AS (SELECT * EXCLUDE (impressions), CASE WHEN clicks = 7 THEN 0 ELSE impressions END AS impressions FROM g), x AS (
  SELECT campaign_id, date_start, CAST(sum(cost) AS DOUBLE) AS cost, CAST(sum(impressions) AS DOUBLE) AS impressions,
         CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(all_conversions) AS DOUBLE) AS all_conversions FROM d GROUP BY 1, 2
)
SELECT *, CASE WHEN impressions > 0 THEN clicks / impressions ELSE 0 END AS ctr_fraction FROM x""",
    "daily_reports": f"""WITH {FACTS}, {CAMPAIGN_OF_AD}, j AS (
  SELECT f.*, p.adset_id, p.campaign_id, p.account_id, p.campaign_name, c_name, r_name
  FROM f JOIN p USING (ad_id) JOIN customer ON adset_id = c_custkey JOIN region ON account_id = r_regionkey
), u AS (
  SELECT 'adset' AS level, date_start, adset_id AS id, c_name AS name, spend, clicks FROM j
  UNION ALL SELECT 'campaign', date_start, campaign_id, campaign_name, spend, clicks FROM j
  UNION ALL SELECT 'account', date_start, account_id, r_name, spend, clicks FROM j
)
SELECT level, date_start, CAST(id AS BIGINT) AS id, name, CAST(sum(spend) AS DOUBLE) AS spend, CAST(sum(clicks) AS BIGINT) AS clicks
FROM u GROUP BY ALL""",
    "batch_search": f"""WITH {SEARCH}, j AS (
  SELECT g.* REPLACE (CASE WHEN clicks % 2 = 1 THEN impressions ELSE impressions * 2 END AS impressions), n_regionkey AS account_id
  FROM g JOIN nation ON campaign_id = n_nationkey
), u AS (
  SELECT 'ad_group' AS level, CAST(adgroup_id AS VARCHAR) AS id, 'Group ' || adgroup_id AS name, * FROM j
  UNION ALL SELECT 'campaign', CAST(campaign_id AS VARCHAR), 'Campaign ' || campaign_id, * FROM j
  UNION ALL SELECT 'account', CAST(account_id AS VARCHAR), 'Account ' || account_id, * FROM j
)
SELECT level, date_start, id, name, CAST(sum(cost) AS DOUBLE) AS cost, CAST(sum(impressions) AS BIGINT) AS impressions,
       CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(all_conversions) AS DOUBLE) AS all_conversions,
       coalesce(CAST(sum(clicks) AS DOUBLE) / nullif(sum(impressions), 0), 0) AS ctr_fraction
FROM u GROUP BY 1, 2, 3, 4""",
    "search_reports": f"""WITH {SEARCH}, j AS (
  SELECT g.*, s_name, n_name, n_regionkey, r_name
  FROM g JOIN supplier ON adgroup_id = s_suppkey JOIN nation ON campaign_id = n_nationkey JOIN region ON n_regionkey = r_regionkey
), u AS (
  SELECT 'ad_group' AS level, adgroup_id AS id, s_name AS name, date_start, cost, impressions, clicks, all_conversions FROM j
  UNION ALL SELECT 'campaign', campaign_id, n_name, date_start, cost, impressions, clicks, all_conversions FROM j
  UNION ALL SELECT 'account', n_regionkey, r_name, date_start, cost, impressions, clicks, all_conversions FROM j
)
SELECT level, date_start, CAST(id AS BIGINT) AS id, name, CAST(sum(cost) AS DOUBLE) AS cost, CAST(sum(impressions) AS BIGINT) AS impressions,
       CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(all_conversions) AS DOUBLE) AS all_conversions,
       coalesce(CAST(sum(clicks) AS DOUBLE) / nullif(sum(impressions), 0), 0) AS ctr_fraction
FROM u GROUP BY 1, 2, 3, 4""",
    "rollup_campaign_totals": f"""WITH {SEARCH}
SELECT campaign_id, date_start, CAST(sum(cost) AS DOUBLE) AS cost, CAST(sum(impressions) AS BIGINT) AS impressions,
       CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(all_conversions) AS DOUBLE) AS all_conversions FROM g GROUP BY 1, 2""",
    "budget_remaining": f"""WITH {FACTS}, {CAMPAIGN_OF_AD}
SELECT date_start, adset_id, CAST(max(daily_budget) AS DOUBLE) AS daily_budget, CAST(sum(spend) AS DOUBLE) AS spend,
       CAST(max(daily_budget) - sum(spend) AS DOUBLE) AS budget_remaining FROM f JOIN p USING (ad_id) GROUP BY 1, 2""",
    "kpi_ratios": f"""WITH {FACTS}
SELECT ad_id, date_start, creative_id, CAST(clicks AS DOUBLE) / nullif(impressions, 0) * 100 AS ctr_pct,
       coalesce(CAST(clicks AS DOUBLE) / nullif(impressions, 0), 0) AS ctr_fraction,
       CAST(spend AS DOUBLE) / nullif(clicks, 0) AS cpc, CAST(spend * 1000 AS DOUBLE) / nullif(impressions, 0) AS cpm,
       CAST(impressions AS DOUBLE) / nullif(clicks, 0) AS frequency,
       CASE WHEN messages > 0 THEN CAST(spend AS DOUBLE) / messages ELSE 0 END AS cost_per_message,
       CAST(spend AS DOUBLE) / greatest(1, messages) AS cost_floored,
       CAST(clicks + messages + clicks + messages + clicks + impressions AS BIGINT) AS engagements FROM f""",
    "funnel_rates": f"""WITH s AS (
  SELECT l_orderkey AS ad_id, l_linenumber AS line, CAST(floor(l_quantity) AS INTEGER) AS q, q * 10 AS i, q * 8 AS v25, q * 5 AS v50,
         q * l_linenumber AS v75, CASE WHEN l_linenumber <> 6 THEN q * 2 END AS v95, CASE WHEN l_linenumber < 5 THEN q END AS v100,
         l_linenumber * 3 AS c, CASE WHEN l_linenumber <> 2 THEN l_linenumber * 2 END AS lc, l_linenumber - 1 AS lp FROM lineitem)
SELECT ad_id, line, {', '.join(
    f"CAST({below} AS DOUBLE) / nullif({above}, 0) AS {name}_rate"
    for above, below, name in (
        ("i", "v25", "video_views_p25"), ("v25", "v50", "video_views_p50"), ("v50", "v75", "video_views_p75"),
        ("v75", "v95", "video_views_p95"), ("v95", "v100", "video_views_p100"),
        ("i", "c", "clicks"), ("c", "lc", "link_clicks"), ("lc", "lp", "landing_page_views"),
    )
)}, i >= v25 AND v25 >= v50 AND v50 >= v75 AND v75 >= coalesce(v95, 0) AND coalesce(v95, 0) >= coalesce(v100, 0)
    AND i >= c AND c >= coalesce(lc, 0) AND coalesce(lc, 0) >= lp AS is_monotone FROM s""",
    "math_scalars": """
SELECT l_orderkey AS ad_id, l_linenumber AS line,
       CAST(round_even(CAST(l_extendedprice AS DECIMAL(18,2)) * 50, 0) AS DOUBLE) / 100 AS half_even,
       CAST(floor(l_extendedprice * 0.015::DOUBLE) AS BIGINT) AS truncated,
       round(1 + log10(greatest(1.0::DOUBLE, l_extendedprice / 50000)), 6) AS inflation,
       least(30, l_linenumber * 5) AS capped, greatest(0, l_linenumber - 4) AS floored FROM lineitem""",
    "hash_ids": """
WITH h AS (SELECT p_partkey, p_name, md5('seed_' || p_partkey) AS h FROM part)
SELECT p_partkey, 'ad_' || substr(h, 1, 15) AS social_id, 'as_' || substr(h, 1, 12) AS search_id,
       substr(CAST(CAST('0x' || substr(h, 1, 12) AS BIGINT) AS VARCHAR), 1, 12) AS numeric_id,
       p_name || ' [#' || upper(substr(h, 1, 3)) || ']' AS tagged_name FROM h""",
    "hash_sample": f"""
WITH k AS (SELECT p_partkey, p_name || '/' || p_partkey AS key FROM part),
pool AS (SELECT 'Asset ' || i AS item FROM generate_series(1, 20) x(i)),
ranked AS (
  SELECT p_partkey, key, item, row_number() OVER (PARTITION BY p_partkey ORDER BY md5(key || '|' || item)) AS rank FROM k CROSS JOIN pool
)
SELECT p_partkey, {hash_number('any_value(key)')} % 17 AS bucket,
       (['MOBILE', 'DESKTOP', 'TABLET'])[{hash_number('any_value(key)')} % 3 + 1] AS device,
       string_agg(item, ',' ORDER BY rank) AS assets
FROM ranked WHERE rank <= 4 GROUP BY p_partkey""",
    "classify_targeting": f"""WITH n AS (
  SELECT c_custkey AS adset_id, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Phụ nữ 18-24' WHEN 'MACHINERY' THEN 'Xe & Nam giới'
    WHEN 'BUILDING' THEN 'Nhóm Quản lý, CEO' WHEN 'FURNITURE' THEN 'Sinh viên 18-24' ELSE 'Mọi người' END AS adset_name
  FROM customer
) SELECT adset_id, adset_name, {AUDIENCE} FROM n""",
    "age_bucket_bounds": """
WITH a AS (SELECT l_orderkey AS ad_id, (['18-24','25-34','35-44','45-54','55-64','65+','unknown'])[l_linenumber] AS age FROM lineitem)
SELECT ad_id, age, TRY_CAST(regexp_extract(age, '^([0-9]+)', 1) AS INTEGER) AS age_min FROM a""",
    "string_trim": """
SELECT p_partkey, substr(replace(p_name, ' ', '_') || '_' || p_type || '_performance_report', 1, 31) AS sheet FROM part""",
    "stream_route_counts": f"""WITH {MESSAGES}
SELECT platform, report_type, CAST(count(*) AS BIGINT) AS records FROM m GROUP BY 1, 2""",
    "stream_raw_archive": f"WITH {MESSAGES} SELECT platform, report_type, ingested_at, id, spend, k FROM m",
    "stream_route_facts": f"""WITH {MESSAGES}, u AS (
  SELECT * FROM ({routed_fact('fact_fb_ad_daily', 'ad_daily', "''")})
  UNION ALL SELECT * FROM ({routed_fact('fact_fb_ad_creative_daily', 'ad_creative', 'CAST(k % 5 AS VARCHAR)')})
  UNION ALL SELECT * FROM ({routed_fact(
      'fact_fb_ad_demographic_daily',
      'age_gender',
      "CASE WHEN k < 50 THEN '18-24' ELSE '25-34' END || '|' || CASE k % 3 WHEN 1 THEN 'female' WHEN 2 THEN 'male' ELSE 'unknown' END",
  )})
)
SELECT table_name, account_id, ad_id, sub_key, date_start, CAST(CAST(spend AS DECIMAL(18,2)) AS DOUBLE) AS spend, impressions, clicks,
       new_messaging_connections FROM u""",
}


def _routed_dim(table: str, report_type: str, key: str, parent: str, name: str, status: str) -> str:
    return f"""SELECT '{table}' AS table_name, {key} AS key, {parent} AS parent, {name} AS name, {status} AS status
  FROM m WHERE platform = 'facebook' AND report_type = '{report_type}'
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY ingested_at DESC, {parent} DESC NULLS LAST, {name} DESC NULLS LAST, {status} DESC NULLS LAST) = 1"""


_NO = "NULL::VARCHAR"
ORACLE["stream_dims"] = f"WITH {MESSAGES} " + " UNION ALL ".join(
    f"SELECT * FROM ({_routed_dim(*shape)})"
    for shape in (
        ("dim_account", "ad_daily", "account_id", _NO, "CASE WHEN k % 3 > 0 THEN 'Account ' || k % 13 ELSE 'Unknown' END", _NO),
        ("dim_campaign", "ad_daily", "CAST(CAST(id AS BIGINT) % 20 AS VARCHAR)", "account_id", "'Campaign ' || k % 11", _NO),
        ("dim_adset", "ad_daily", "CAST(CAST(id AS BIGINT) % 50 AS VARCHAR)", "CAST(CAST(id AS BIGINT) % 20 AS VARCHAR)",
         "CASE WHEN k % 5 > 0 THEN 'Set ' || k % 7 ELSE 'Unknown' END", _NO),
        ("dim_ad", "ad_daily", "id", "CAST(CAST(id AS BIGINT) % 50 AS VARCHAR)",
         "CASE WHEN k % 4 > 0 THEN 'Ad ' || k % 9 ELSE 'Unknown' END", "CASE WHEN k % 2 > 0 THEN 'PAUSED' ELSE 'UNKNOWN' END"),
        ("dim_creative", "ad_creative", "CAST(k % 5 AS VARCHAR)", _NO, "'Title ' || k % 6",
         "CASE WHEN k % 7 > 0 THEN 'Page ' || k % 8 ELSE 'Unknown' END"),
    )
)


def _merged(key: str, order: str, extra: str = "") -> str:
    """The newest version of every row after the three loads."""
    return f"""m AS (
  SELECT * FROM (
    SELECT 1 AS load, 1.0 AS version, 1 AS factor, f.*{extra} FROM f
    UNION ALL SELECT 2, 2.0, 2, f.*{extra} FROM f WHERE clicks % 2 = 1
    UNION ALL SELECT 3, 1.5, 3, f.*{extra} FROM f WHERE date_start BETWEEN DATE '1995-01-01' AND DATE '1995-03-31'
  ) QUALIFY row_number() OVER (PARTITION BY {key}, date_start ORDER BY {order} DESC) = 1
)"""


_HISTORY = f"""{REPORT}, days AS (
  SELECT campaign_id, date_start, account_id, campaign_name FROM r
  QUALIFY row_number() OVER (PARTITION BY campaign_id, date_start ORDER BY account_id DESC, campaign_name DESC) = 1
), c AS (
  SELECT *, lag(campaign_name) OVER w AS name_before, lag(account_id) OVER w AS account_before, row_number() OVER w AS n
  FROM days WINDOW w AS (PARTITION BY campaign_id ORDER BY date_start)
), h AS (
  SELECT campaign_id, account_id, campaign_name, date_start AS valid_from,
         lead(date_start) OVER (PARTITION BY campaign_id ORDER BY date_start) AS valid_to
  FROM c WHERE n = 1 OR name_before IS DISTINCT FROM campaign_name OR account_before IS DISTINCT FROM account_id
)"""

ORACLE |= {
    "merge_on_write": f"""WITH {FACTS}, {_merged('ad_id, clicks', 'version')}
SELECT strftime(date_start, '%Y%m') AS ym, CAST(count(*) AS BIGINT) AS records, CAST(sum(spend * factor) AS DOUBLE) AS spend,
       CAST(sum(clicks) AS BIGINT) AS clicks, strftime(date_start, '%Y%m') NOT IN ('199501', '199502', '199503') AS kept FROM m GROUP BY ym, kept""",
    "rollup_incremental": f"""WITH {FACTS}, {CAMPAIGN_OF_AD}, {_merged('ad_id, clicks', 'load')}, j AS (
  SELECT m.*, p.adset_id, p.campaign_id, p.account_id FROM m JOIN p USING (ad_id)
)
SELECT date_start, level, id, CAST(count(*) AS BIGINT) AS records, CAST(sum(spend * factor) AS DOUBLE) AS spend,
       CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks
FROM (
  SELECT *, 'adset' AS level, CAST(adset_id AS VARCHAR) AS id FROM j
  UNION ALL SELECT *, 'campaign', CAST(campaign_id AS VARCHAR) FROM j
  UNION ALL SELECT *, 'account', CAST(account_id AS VARCHAR) FROM j
) GROUP BY 1, 2, 3""",
    "dim_history": f"""WITH {_HISTORY} SELECT *, valid_to IS NULL AS is_current FROM h""",
    "fact_as_of_history": f"""WITH {_HISTORY}
SELECT r.date_start, r.campaign_id, h.campaign_name, CAST(sum(spend) AS DOUBLE) AS spend, CAST(sum(clicks) AS BIGINT) AS clicks
FROM r JOIN h ON r.campaign_id = h.campaign_id AND r.date_start >= h.valid_from AND (h.valid_to IS NULL OR r.date_start < h.valid_to)
GROUP BY 1, 2, 3""",
    "join_overlaps": """
WITH o AS (SELECT o_orderkey AS ad_id, o_custkey AS adset_id, CAST(o_orderdate AS DATE) AS s,
                  CAST(o_orderdate AS DATE) + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 15 AS e FROM orders)
SELECT a.adset_id, a.ad_id AS ad_a, b.ad_id AS ad_b, greatest(a.s, b.s) AS overlap_start, least(a.e, b.e) AS overlap_end
FROM o a JOIN o b ON a.adset_id = b.adset_id AND a.ad_id < b.ad_id AND a.s <= b.e AND b.s <= a.e""",
    "cluster_two_keys": f"""WITH {FACTS}, b AS (
  SELECT CAST(i AS INTEGER) AS box, floor((SELECT max(creative_id) FROM f) * i / 6) AS from_id, floor((SELECT max(creative_id) FROM f) * (i + 1) / 6) AS to_id,
         DATE '1995-03-01' + CAST(i * 350 AS INTEGER) AS from_day, DATE '1995-03-01' + CAST(i * 350 + 90 AS INTEGER) AS to_day
  FROM range(6) x(i)
)
SELECT box, CAST(count(*) AS BIGINT) AS records, CAST(sum(clicks) AS BIGINT) AS clicks, TRUE AS fewer_files
FROM f JOIN b ON creative_id BETWEEN from_id AND to_id AND date_start BETWEEN from_day AND to_day GROUP BY box""",
}

ORACLE |= {
    "stream_dedup": f"WITH {MESSAGES} SELECT DISTINCT platform, report_type, ingested_at, id, spend, k FROM m",
    "stream_windows": f"""WITH {MESSAGES}
SELECT date_start, platform, report_type, CAST(count(*) AS BIGINT) AS records,
       CAST(sum(CAST(spend AS DECIMAL(18,2))) AS DOUBLE) AS spend, CAST(sum(k) AS BIGINT) AS clicks
FROM m WHERE date_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY GROUP BY 1, 2, 3""",
}

ORACLE["reach_by_sketch"] = f"""WITH e AS (SELECT user_id, CAST({K} AS INTEGER) AS k FROM events), u AS (
  SELECT 'ad' AS level, k AS id, user_id FROM e UNION ALL SELECT 'campaign', k % 10, user_id FROM e UNION ALL SELECT 'all', 0, user_id FROM e
) SELECT level, id, CAST(count(DISTINCT user_id) AS BIGINT) AS people, TRUE AS within_error FROM u GROUP BY 1, 2"""

_SESSIONS = """e AS (
  SELECT user_id, ts, event_type, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS opens
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
), n AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM e), t1 AS (
  SELECT user_id, session, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events, min(ts) FILTER (event_type = 'view') AS at1 FROM n GROUP BY 1, 2
), t2 AS (
  SELECT t1.*, (SELECT min(ts) FROM n WHERE n.user_id = t1.user_id AND n.session = t1.session AND event_type = 'click' AND ts >= at1) AS at2 FROM t1
), t3 AS (
  SELECT t2.*, (SELECT min(ts) FROM n WHERE n.user_id = t2.user_id AND n.session = t2.session AND event_type = 'signup' AND ts >= at2) AS at3 FROM t2
), t4 AS (
  SELECT t3.*, (SELECT min(ts) FROM n WHERE n.user_id = t3.user_id AND n.session = t3.session AND event_type = 'purchase' AND ts >= at3) AS at4 FROM t3
), s AS (
  SELECT user_id, session_start, session_end, CAST(events AS BIGINT) AS events,
         CASE WHEN at1 IS NULL THEN 0 WHEN at2 IS NULL THEN 1 WHEN at3 IS NULL THEN 2 WHEN at4 IS NULL THEN 3 ELSE 4 END AS reached FROM t4
)"""

ORACLE |= {
    "funnel_sessions": f"WITH {_SESSIONS} SELECT * REPLACE (epoch_us(session_start) AS session_start, epoch_us(session_end) AS session_end) FROM s",
    "funnel_report": f"""WITH {_SESSIONS}, c AS (
  SELECT CAST(session_start AS DATE) AS day, position, (['view', 'click', 'signup', 'purchase'])[position] AS step,
         CAST(count(*) FILTER (reached >= position) AS BIGINT) AS sessions
  FROM s, (SELECT CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS position) GROUP BY 1, 2
)
SELECT *, sessions / nullif(CAST(coalesce(lag(sessions) OVER w, sessions) AS DOUBLE), 0) AS from_previous,
       sessions / nullif(CAST(first_value(sessions) OVER w AS DOUBLE), 0) AS from_first
FROM c WINDOW w AS (PARTITION BY day ORDER BY position)""",
}

ORACLE["load_ledger"] = f"""WITH e AS ({EVENT_ROWS})
SELECT *, CAST(1 + event_id % 2 AS INTEGER) AS run, CAST(count(*) OVER () AS BIGINT) AS in_ledger FROM e"""
