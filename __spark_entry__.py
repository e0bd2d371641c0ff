"""

Queries hand over native results of the library; only at this boundary are times, dates, booleans and arrays
written as text, so that both engines are compared on the same representation.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clickloom import configure
from clickloom.functions import parse_export_time
from clickloom.operators import flatten as flat
from clickloom.operators.carried import asof_time
from clickloom.operators.upsert import upsert
from clickloom.plans import anonymize, enrich, explore, profile, star, video
from clickloom.schema import HR_FIELDS
from clickloom.session import materialize
from oracle import bindings, deliveries, maintained
from oracle.queries import ORACLE
from oracle.views import DAYS, PEPPER

try:  # the corpus operators may be absent; everything else works without them
    import corpus_pipeline
    from clickloom.llm import queries as corpus_queries
except ImportError as error:
    if error.name not in ("corpus_pipeline", "clickloom.llm"):
        raise
    corpus_pipeline = corpus_queries = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF = datetime(2025, 1, 1)
DEFAULT_LOOKBACK_DAYS = 90


# Whole numbers with NULLs, which some clients hold as floating point.
OFTEN_NULL = {"ms_since_prev_event"}


def comparable(df: DataFrame, digits: int | None = None) -> DataFrame:
    def shown(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, (T.DateType, T.BooleanType)):
            column = column.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, "|")
        elif field.name in OFTEN_NULL:
            column = column.cast("double")
        elif isinstance(field.dataType, T.DoubleType) and digits is not None:
            column = F.round(column, digits)
        return column.alias(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def _log(spark: SparkSession, sf_dir: str, days: int = DAYS, name: str | None = flat.CLICK_EVENT):
    return flat.recent(bindings.raw_log(spark, sf_dir), AS_OF, days, name)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich(bindings.click_events(spark, sf_dir), bindings.hr(spark, sf_dir))


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with person and session columns only: enough for reports that read no gaps."""
    source_rows = bindings.click_events(spark, sf_dir)
    return enrich.with_organisation(enrich.with_session_columns(source_rows), bindings.hr(spark, sf_dir))


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_session_columns(bindings.click_events(spark, sf_dir))


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return video.segments(video.video_events(_sessions(spark, sf_dir)))


def _engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return video.video_engagement(_sessions(spark, sf_dir))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = materialize(_events(spark, sf_dir), "events")
    return star.fact_event(events, star.dimensions(events), PEPPER)


def _session_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = enrich.with_event_order(_sessions(spark, sf_dir))
    return ordered.select(
        "event_id", "gpn", "email", "timestamp_str", "timestamp_cet", "timestamp_cet_str",
        "session_date", "session_key", "event_hour", "event_weekday", "event_weekday_num",
        "event_order", "prev_event", "prev_timestamp", "ms_since_prev_event",
        "sec_since_prev_event", "time_since_prev_bucket",
    )


def _hr_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(spark, sf_dir).select("event_id", "gpn", *HR_FIELDS.values())


def _hr_asof_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly snapshots carried forward from the first of their month."""
    hr = bindings.hr(spark, sf_dir)
    known = {source: name for source, name in HR_FIELDS.items() if source in hr.columns}
    taken = F.make_date("snapshot_year", "snapshot_month", F.lit(1))
    told = asof_time(_sessions(spark, sf_dir), hr, "gpn", F.col("timestamp"), taken, known)
    return told.select("event_id", "gpn", *known.values())


def _asof_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of users with what the newest of many daily records said, orders standing in for records."""
    orders = bindings.read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.expr("timestamp '2024-01-01' + make_dt_interval(o_orderkey % 30)").alias("taken"),
        F.expr("case when o_orderkey % 4 > 0 then o_orderpriority end").alias("o_orderpriority"),
        "o_orderkey",
    )
    events = bindings.read(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    fields = {"o_orderkey": "record", "o_orderpriority": "priority"}
    told = asof_time(events, orders, "user_id", F.col("ts"), F.col("taken"), fields)
    return told.select("event_id", "user_id", F.col("record").cast("double").alias("record"), "priority")


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.organization_history(bindings.hr(spark, sf_dir))


def _event_org_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    versioned = star.with_org_version(_sessions(spark, sf_dir), _history(spark, sf_dir))
    return versioned.select("event_id", "gpn", F.col("org_version_key").cast("double").alias("org_version_key"))


def _unique_seconds(mode: str) -> Query:
    return lambda s, d: video.unique_seconds(materialize(_segments(s, d), "segments"), mode)


def _video_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    segs = materialize(_segments(spark, sf_dir), "segments")
    return video.sessions(segs, video.unique_seconds(segs))


def _video_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir).select(
        "timestamp", "gpn", "session_id", "video_id", "action", "prev_action", "time_delta",
        "timestamp_delta", "is_valid_segment", "watched_seconds", "jump_type",
    )


def _upsert_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything is delivered once; everything since June again, and since October a third time."""
    first = bindings.click_events(spark, sf_dir).select(
        "timestamp",
        "user_id",
        F.expr("case when event_id % 31 > 0 then session_id end").alias("session_id"),
        "name",
        "event_id",
        F.lit("first").alias("delivery"),
    )
    since = F.col("timestamp")
    second = first.where(since >= "2024-06-01").withColumns({"delivery": F.lit("second"), "rank": F.lit(1)})
    third = first.where(since >= "2024-10-01").withColumns({"delivery": F.lit("third"), "rank": F.lit(2)})
    return upsert(first, second.unionByName(third), rank="rank")


def _date_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every click time spelled in one of the accepted ways (or an unusable one), and parsed back."""
    ts = F.col("timestamp")
    spelled = {
        0: F.concat(F.date_format(ts, "dd/MM/yyyy HH:mm:ss.SSSSSS"), F.lit("7")),
        1: F.date_format(ts, "dd/MM/yyyy HH:mm:ss.SSSSSS"),
        2: F.date_format(ts, "dd/MM/yyyy HH:mm:ss.SSS"),
        3: F.date_format(ts, "dd/MM/yyyy HH:mm:ss"),
        4: F.date_format(ts, "dd/MM/yyyy HH:mm"),
        5: F.date_format(ts, "dd/MM/yyyy"),
        6: F.date_format(ts, "dd.MM.yyyy HH:mm:ss"),
        7: F.date_format(ts, "dd.MM.yyyy HH:mm"),
        8: F.date_format(ts, "dd.MM.yyyy"),
        9: F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
        10: F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        11: F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"),
        12: F.date_format(ts, "'31/02/'yyyy HH:mm:ss"),
        13: F.lit("soon"),
    }
    form = F.col("event_id") % len(spelled)
    text = F.lit(None)
    for number, spelling in spelled.items():
        text = F.when(form == number, spelling).otherwise(text)
    return (
        bindings.click_events(spark, sf_dir)
        .select("event_id", text.alias("spelled"))
        .withColumn("parsed", parse_export_time(F.col("spelled")))
    )


def _number(column: str):
    """A count, whether written with digit group marks or not."""
    return F.replace(F.col(column).cast("string"), F.lit("'"), F.lit("")).cast("long")


def _beside_estimates(exact: DataFrame, estimated: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    """The exact report, and for each estimated count whether it is within 5 % of the exact one."""
    near = {c: F.abs(_number(f"`~{c}`") - _number(c)) <= F.lit(0.05) * _number(c) for c in counts}
    sides = exact.withColumn("~one", F.lit(1)), estimated.withColumn("~one", F.lit(1))
    other = sides[1].select("~one", *keys, *[F.col(c).alias(f"~{c}") for c in counts])
    joined = sides[0].join(other, ["~one", *keys], "left")
    return joined.select(*exact.columns, *[flag.alias(f"{c}_close") for c, flag in near.items()])


def _native_queries() -> dict[str, Query]:
    return {
        # raw log: extraction and exploration
        "daily_trend": lambda s, d: explore.daily_trend(_log(s, d)),
        "daily_trend_90d": lambda s, d: explore.daily_trend(_log(s, d, DEFAULT_LOOKBACK_DAYS)),
        "event_names": lambda s, d: explore.event_names(_log(s, d, name=None)),
        "volume_overview": lambda s, d: explore.volume_overview(_log(s, d), PEPPER),
        "volume_overview_approx": lambda s, d: _beside_estimates(
            explore.volume_overview(_log(s, d), PEPPER),
            explore.volume_overview(_log(s, d), PEPPER, approx=True),
            [],
            ["unique_visitors_user_id", "unique_persons_gpn", "unique_persons_hash", "unique_sessions"],
        ),
        "distinct_people": lambda s, d: explore.distinct_people(_log(s, d), PEPPER),
        "link_type_share": lambda s, d: explore.link_types(_log(s, d)),
        "link_type_samples": lambda s, d: explore.link_type_samples(_log(s, d)),
        "link_component_topk": lambda s, d: explore.link_type_by_component(_log(s, d)),
        "page_topk": lambda s, d: explore.top_pages(_log(s, d)),
        "page_topk_certified": lambda s, d: explore.frequent_pages(_log(s, d)),
        "link_topk_certified": lambda s, d: explore.frequent_links(_log(s, d)),
        "site_distribution": lambda s, d: explore.sites(_log(s, d)),
        "content_link_topk": lambda s, d: explore.content_by_link_type(_log(s, d)),
        "link_domains": lambda s, d: explore.link_domains(_log(s, d)),
        "file_types": lambda s, d: explore.file_types(_log(s, d)),
        "field_profile": lambda s, d: explore.field_profile(_log(s, d)),
        "key_inventory": lambda s, d: explore.property_keys(_log(s, d)),
        "key_inventory_approx": lambda s, d: _beside_estimates(
            explore.property_keys(_log(s, d)),
            explore.property_keys(_log(s, d), approx=True),
            ["key"],
            ["distinct_values"],
        ),
        "raw_sample": lambda s, d: explore.raw_sample(_log(s, d)).withColumn(
            "properties",
            F.array_sort(F.transform(F.map_entries("properties"), lambda p: F.concat(p["key"], F.lit("="), p["value"]))),
        ),
        "flatten_props": lambda s, d: flat.export_view(flat.flatten(_log(s, d))),
        "flatten_unprefixed": lambda s, d: flat.flatten(_log(s, d), prefix=""),
        "anonymized_flat": lambda s, d: flat.pseudonymous_flat(_log(s, d), PEPPER),
        "email_filter": lambda s, d: flat.flatten(flat.with_email_containing(_log(s, d), "USER1")),
        # enrichment
        "session_enriched": _session_enriched,
        "hr_asof": _hr_asof,
        "hr_asof_carried": _hr_asof_carried,
        "asof_daily": _asof_daily,
        "events_anonymized": lambda s, d: anonymize.anonymize(_events(s, d), PEPPER),
        "date_formats": _date_formats,
        "precision_check": lambda s, d: profile.precision_check(bindings.click_events(s, d)),
        "local_time_sample": lambda s, d: enrich.local_time_sample(_sessions(s, d)),
        "upsert_overlap": _upsert_overlap,
        "ingest_delta": deliveries.stored_events,
        "manifest_report": deliveries.manifest,
        "column_kinds": deliveries.column_kinds,
        # video engagement
        "video_actions": lambda s, d: video.action_distribution(video.video_events(_sessions(s, d))),
        "video_segments": _video_segments,
        "video_segment_totals": lambda s, d: video.segment_totals(_segments(s, d)),
        "video_unique_seconds": _unique_seconds("lag"),
        "video_unique_seconds_union": _unique_seconds("running_max"),
        "video_sessions": _video_sessions,
        "video_views": lambda s, d: video.views(_segments(s, d)),
        "video_metadata": lambda s, d: video.metadata(video.video_events(_sessions(s, d))),
        "video_engagement": _engagement,
        "engagement_summary": lambda s, d: video.engagement_summary(_engagement(s, d)),
        "tier_distribution": lambda s, d: video.tier_distribution(_engagement(s, d)),
        # star schema
        "dim_date": lambda s, d: star.dim_date(_sessions(s, d)),
        "dim_organization": lambda s, d: star.dim_organization(_people(s, d)),
        "dim_organization_history": _history,
        "event_org_version": _event_org_version,
        "dim_site": lambda s, d: star.dim_site(_sessions(s, d)),
        "dim_page": lambda s, d: star.dim_page(_sessions(s, d)),
        "dim_link_type": lambda s, d: star.dim_link_type(_sessions(s, d)),
        "dim_component": lambda s, d: star.dim_component(_sessions(s, d)),
        "fact_event": _fact,
        # derived tables that follow deliveries
        "stable_keys": maintained.stable_keys,
        "fact_incremental": maintained.fact,
        "video_incremental": maintained.engagement,
        # the log stored by day, and its sketches
        "log_route": maintained.log_route,
        "log_streamed": maintained.log_streamed,
        "daily_trend_stored": maintained.recent_from_store,
        "visits_sketched": maintained.visits_sketched,
        "property_values_sketched": maintained.property_values_sketched,
        # profile reports
        "data_overview": lambda s, d: profile.data_overview(_sessions(s, d)),
        "hr_profile": lambda s, d: profile.hr_profile(bindings.hr(s, d)),
        "hr_coverage": lambda s, d: profile.hr_coverage(_people(s, d)),
        "top_divisions": lambda s, d: profile.top_divisions(_people(s, d)),
        "unmatched_people": lambda s, d: profile.unmatched_people(_people(s, d)),
        "field_coverage": lambda s, d: profile.field_coverage(_people(s, d)),
        "share_by_name": lambda s, d: profile.event_types(_sessions(s, d)),
        "share_by_link_type": lambda s, d: profile.share_by(_sessions(s, d), "link_type", "link_type"),
        "share_by_component": lambda s, d: profile.share_by(_sessions(s, d), "component", "component", 10),
        "share_by_site": lambda s, d: profile.share_by(_sessions(s, d), "site_name", "site_name", 10),
    }


# Sums of doubles depend on the order of addition in the last digits, in both engines.
SUMMED = {
    "video_segments", "video_unique_seconds", "video_unique_seconds_union", "video_sessions",
    "video_segment_totals",
}


def queries() -> dict[str, Query]:
    def registered(name: str, query: Query) -> Query:
        digits = 6 if name in SUMMED else None
        return lambda spark, sf_dir: comparable(query(configure(spark), sf_dir), digits)

    found = {name: registered(name, query) for name, query in _native_queries().items()}
    if corpus_queries:
        own = {**corpus_queries.QUERIES, "pipeline": corpus_pipeline.run}
        found |= {name: lambda s, d, query=query: query(configure(s), d) for name, query in own.items()}
    return found


def oracle_sql() -> dict[str, str]:
    own = dict(corpus_queries.ORACLE) if corpus_queries else {}
    if corpus_queries and corpus_pipeline.ORACLE_SQL:
        own["pipeline"] = corpus_pipeline.ORACLE_SQL
    return dict(ORACLE) | own


def entry(spark: SparkSession) -> DataFrame:
    """Click events with local time, session order and organisation fields."""
    return _events(configure(spark), SMOKE_DIR)
