"""Click-stream views of the driver's test tables.

Each column is one SQL expression over ``events`` (plus ``k``, the number inside ``props``) that reads the
same in Spark and in DuckDB, so the oracle starts from the same rows. Only the click time, ``k`` and
the integer division are spelled per engine.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.session import compiled_in_parts, materialize

# Days are shifted per user and the time of day is squeezed into 22:30:00 to 22:31:26, so gaps are short and
# local midnight is crossed in summer.
CLICK_MICROS = (
    "{day} + (user_id % 12) * 30 * 86400000000 + 81000000000 + ({micros} - {day}) {div} 1000"
)

COMMON = {
    "name": "case when event_type = 'error' and event_id % 2 = 0 then 'page_view' else 'click_event' end",
    "user": "concat('u', user_id)",
    "session": "concat('s', user_id % 3)",
    "country": "concat('C', user_id % 7)",
}

# Property key -> expression. NULL leaves the key out, except for NULLABLE keys, which become JSON null.
PROPERTIES = {
    "SiteID": "concat('site', k % 5)",
    "SiteName": "concat('Site ', k % 5)",
    "PageId": "concat('p', k % 20)",
    "PageName": "concat('Page ', k % 20)",
    "PageURL": "concat('https://intra.example.com/p/', k % 20, '?v=', k % 3)",
    "PageStatus": "case when event_id % 19 = 0 then '' when k % 2 = 0 then 'published' else 'draft' end",
    "ComponentName": "concat('comp', k % 8)",
    "ContentType": "case when event_id % 17 > 0 then concat('ct', k % 4) end",
    "Email": "concat('user', user_id, '@example.com')",
    "GPN": "case when event_id % 97 = 0 then null when event_id % 89 = 0 then '' "
    "when event_id % 5 = 0 then concat(user_id, '.0') else cast(user_id as string) end",
    "FileType_Label": "case when event_id % 3 = 0 then "
    "case k % 4 when 0 then 'pdf' when 1 then 'docx' when 2 then 'xlsx' else '' end end",
    "FileName_Label": "case when event_id % 3 = 0 then concat('file', k % 30) end",
    "Link_Type": "case when event_id % 11 > 0 then event_type end",
    "Link_address": "case event_id % 10 when 9 then null when 8 then concat('/relative/', k) "
    "when 7 then concat('http://host', k % 9, '.example.com/path/', k) "
    "else concat('https://host', k % 9, '.example.org/path/', k) end",
    "Link_label": "case when event_id % 7 = 0 then null when event_id % 13 = 0 then '' "
    "else concat('label ', k % 12) end",
    "Topic": "case when event_id % 4 = 0 then concat('topic', k % 40) end",
    "Theme": "case when event_id % 5 = 0 then concat('theme', k % 6) end",
    "TargetOrganisation": "case when event_id % 6 = 0 then concat('org', k % 25) end",
    "TargetRegion": "case when event_id % 7 = 3 then '' when event_id % 2 = 0 then concat('region', k % 3) end",
    "refUri": "case when event_id % 8 = 0 then 'https://ref.example.com/' end",
    "Video_Action": "case event_type when 'click' then ' Play ' when 'view' then 'resume' "
    "when 'signup' then 'PAUSE' when 'purchase' then 'ended' end",
    "Video_Id": "concat('v', event_id % 4)",
    "Video_Type": "case when event_id % 2 = 0 then 'internal' else 'external' end",
    "Video_Duration": "case when event_id % 4 < 3 then '480.0' end",
    "Video_PlayedTime": "cast(cast(floor(value) as bigint) as string)",
    "Video_Title": "case when event_id % 23 > 0 then concat('Title ', event_id % 4, ' rev ', k % 3) end",
    "Video_Address": "concat('https://video.example.com/', event_id % 4)",
}
NULLABLE = ("Link_Type", "ContentType", "GPN")
# Rows of the given events that one task composes.
TASK_ROWS = 100_000
# Properties of the raw log alone: a second spelling of a key, which is another key.
LOG_PROPERTIES = PROPERTIES | {"gpn": "case when event_id % 43 = 0 then concat('9', user_id) end"}
FLAT_ONLY = {
    "CP_Video_Duration": "case when event_id % 4 < 3 then cast('480.0' as double) end",
    "CP_Video_PlayedTime": "value",
}

# Organisation fields of a snapshot. Some change with the months, some are missing for some people or months.
HR_VALUES = {
    "gcrs_division_desc": "case when (o_custkey + o_orderkey {div} 2) % 5 > 0 then o_orderstatus end",
    "gcrs_unit_desc": "case when o_custkey % 4 > 0 then concat('unit ', o_custkey % 5) end",
    "gcrs_area_desc": "concat('area ', o_custkey % 3)",
    "gcrs_sector_desc": "case when o_custkey % 9 = 0 then '' else concat('sector ', o_custkey % 2) end",
    "gcrs_segment_desc": "'segment'",
    "gcrs_function_desc": "concat('function ', o_custkey % 4)",
    "ou_code": "case when o_orderkey % 4 > 0 then concat('ou', o_orderkey {div} 8 % 2) end",
    "work_location_country": "concat('country ', o_custkey % 3)",
    "work_location_region": "case when o_custkey % 3 = 1 then 'north' else 'south' end",
    "job_title": "o_orderpriority",
    "job_family": "substring(o_orderpriority, 1, 1)",
    "management_level": "case when o_orderpriority < '3' then 'senior' else 'junior' end",
    "cost_center": "concat('cc', o_custkey % 4)",
}
# Every order is a snapshot row of a customer: a third of them have snapshots from June 2024 only, one in
# seven belongs to nobody in the click data, and some months carry no division.
HR = f"""
select lpad(cast(case when o_custkey % 7 = 3 then o_custkey + 1000000 else o_custkey end as string), 8, '0')
         as gpn,
       case when o_custkey % 3 = 0 then 2024 else 2023 + cast(o_orderkey % 2 as int) end as snapshot_year,
       case when o_custkey % 3 = 0 then 6 + cast((o_orderkey {{div}} 2) % 7 as int)
            else 1 + 3 * cast((o_orderkey {{div}} 2) % 4 as int) end as snapshot_month,
       {", ".join(f"max({value}) as {name}" for name, value in HR_VALUES.items())}
from {{orders}} group by 1, 2, 3
"""


def properties_json(properties: Mapping[str, str] = LOG_PROPERTIES) -> str:
    """SQL text for the inner JSON document: every property, plus one nested value."""
    parts = []
    for key, expr in properties.items():
        absent = f"',\"{key}\":null'" if key in NULLABLE else "''"
        parts.append(
            f"case when ({expr}) is null then {absent} else concat(',\"{key}\":\"', {expr}, '\"') end"
        )
    return "concat('{\"ContentOwner\":{\"id\":', k % 4, '}', " + ", ".join(parts) + ", '}')"


def details_json(properties: Mapping[str, str] = LOG_PROPERTIES) -> str:
    """SQL text for the outer document, with missing, empty, foreign and malformed cases among it."""
    quote = "concat(chr(92), '\"')"
    wrapped = f"concat('{{\"CustomProps\":\"', replace({properties_json(properties)}, '\"', {quote}), '\"}}')"
    broken = "concat('{\"CustomProps\":\"{', chr(92), '\"GPN', chr(92), '\": broken\"}')"
    return f"""case when event_id % 127 = 0 then null
        when event_id % 101 = 0 then ''
        when event_id % 103 = 0 then '{{"Other":"x"}}'
        when event_id % 107 = 0 then '{{"CustomProps":"not json"}}'
        when event_id % 109 = 0 then {broken}
        when event_id % 113 = 0 then '{{"CustomProps":"{{}}"}}'
        else {wrapped} end"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Stored rows dealt evenly to tasks whose number grows with them, whatever files they lie in.

    They are counted from the footers, and dealt while they are narrow: what is composed of them is far larger.
    """
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS)))


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spread(read(spark, sf_dir, "events"))
    ts = F.col("ts").cast("timestamp")  # stored without zone; the session zone is UTC
    micros = CLICK_MICROS.format(
        day="unix_micros(date_trunc('day', ts))", micros="unix_micros(ts)", div="div"
    )
    return (
        events.withColumn("ts", ts)
        .withColumn("k", F.get_json_object("props", "$.k").cast("int"))
        .withColumn("timestamp", F.timestamp_micros(F.expr(micros)))
    )


_stored: dict[tuple[str, str, str], DataFrame] = {}


def _stored_table(spark: SparkSession, sf_dir: str, name: str, compose) -> DataFrame:
    """The view as a stored table, written once per session and spread over tasks (see ``spread``).

    Click logs and click events are stored tables in use: queries then scan them, with their filters and
    columns, instead of composing every string again from one small file.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        with compiled_in_parts(spark):
            _stored[key] = materialize(compose(spark, sf_dir), name)
    return _stored[key]


def click_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat click events, as stored after loading an export."""
    return _stored_table(spark, sf_dir, "click-events", compose_click_events)


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log rows with doubly encoded properties."""
    return _stored_table(spark, sf_dir, "raw-log", compose_log)


def compose_click_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = {"CP_" + key: expr for key, expr in PROPERTIES.items()} | FLAT_ONLY
    return _base(spark, sf_dir).select(
        "event_id",
        "timestamp",
        F.expr(COMMON["name"]).alias("name"),
        F.expr(COMMON["user"]).alias("user_id"),
        F.expr(COMMON["session"]).alias("session_id"),
        F.expr(COMMON["country"]).alias("client_CountryOrRegion"),
        *[F.expr(expr).alias(column) for column, expr in flat.items()],
    )


def compose_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every property is a column first, so that its expression is evaluated once and not wherever the text names it.
    columns = {key: f"__property_{n}" for n, key in enumerate(LOG_PROPERTIES)}
    valued = _base(spark, sf_dir).select("*", *[F.expr(LOG_PROPERTIES[key]).alias(c) for key, c in columns.items()])
    return valued.select(
        "timestamp",
        F.expr(COMMON["name"]).alias("name"),
        F.expr(COMMON["user"]).alias("user_Id"),
        F.expr(COMMON["session"]).alias("session_Id"),
        F.expr(COMMON["country"]).alias("client_CountryOrRegion"),
        F.expr(details_json(columns)).alias("customDimensions"),
        "event_id",
    )


def hr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(HR.format(div="div", orders="{orders}"), orders=read(spark, sf_dir, "orders"))
