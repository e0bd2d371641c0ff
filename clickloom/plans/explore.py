"""Exploration reports over the raw log. Each takes log rows already limited to a time range.

Distinct counts are exact unless ``approx`` is set, which swaps them for HyperLogLog sketches that need
no shuffle of the values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions import link_host, peppered_sha256, thousands
from clickloom.operators.flatten import (
    DETAILS,
    key_inventory,
    property_bag,
    with_properties,
)
from clickloom.operators.frequent import most_frequent
from clickloom.operators.shares import smallest_values, top, with_share
from clickloom.session import materialize

APPROX_ERROR = 0.016


def _distinct(column: str, approx: bool) -> Column:
    return F.approx_count_distinct(column, APPROX_ERROR) if approx else F.count_distinct(column)


def distinct_people(log: DataFrame, pepper: str) -> DataFrame:
    """Users against person numbers against hashed person numbers."""
    people = with_properties(log, {"gpn": "GPN"}, ["user_Id"]).select(
        F.coalesce("user_Id", F.lit("")).alias("user"),
        "gpn",
        peppered_sha256(F.col("gpn"), pepper).alias("person_hash"),
    )
    counts = people.agg(
        F.count_distinct("user").alias("users"),
        F.count_distinct("gpn").alias("gpns"),
        F.count_distinct("person_hash").alias("hashes"),
    )
    return counts.select(
        thousands(F.col("users")).alias("exact_user_id"),
        thousands(F.col("gpns")).alias("exact_gpn"),
        thousands(F.col("hashes")).alias("exact_hash"),
        F.round(F.try_divide(F.col("users").cast("double"), F.col("gpns")), 2).alias(
            "ratio_user_id_to_gpn"
        ),
    )


def volume_overview(log: DataFrame, pepper: str, approx: bool = False) -> DataFrame:
    columns = ["user_Id", "session_Id", "client_CountryOrRegion", "timestamp"]
    people = with_properties(log, {"gpn": "GPN"}, columns).withColumn(
        "person_hash", peppered_sha256(F.col("gpn"), pepper)
    )
    counts = people.agg(
        F.count("*").alias("total"),
        _distinct("user_Id", approx).alias("users"),
        _distinct("gpn", approx).alias("gpns"),
        _distinct("person_hash", approx).alias("hashes"),
        _distinct("session_Id", approx).alias("sessions"),
        F.min("timestamp").alias("first_event"),
        F.max("timestamp").alias("last_event"),
        _distinct("client_CountryOrRegion", approx).alias("countries"),
    )
    return counts.select(
        thousands(F.col("total")).alias("total_events"),
        thousands(F.col("users")).alias("unique_visitors_user_id"),
        thousands(F.col("gpns")).alias("unique_persons_gpn"),
        thousands(F.col("hashes")).alias("unique_persons_hash"),
        thousands(F.col("sessions")).alias("unique_sessions"),
        "first_event",
        "last_event",
        "countries",
    )


def event_names(log: DataFrame) -> DataFrame:
    return top(log.groupBy("name").agg(F.count("*").alias("event_count")), "event_count", ["name"])


def property_keys(log: DataFrame, approx: bool = False) -> DataFrame:
    inventory = key_inventory(log, APPROX_ERROR if approx else None)
    return top(inventory, "key_count", ["key"])


def link_types(log: DataFrame, approx: bool = False) -> DataFrame:
    rows = with_properties(log, {"link_type": "Link_Type"}, ["user_Id", "session_Id"])
    counts = rows.groupBy("link_type").agg(
        F.count("*").alias("event_count"),
        _distinct("user_Id", approx).alias("unique_users"),
        _distinct("session_Id", approx).alias("unique_sessions"),
    )
    return top(with_share(counts, "event_count", "pct", 2, log), "event_count", ["link_type"])


def link_type_samples(log: DataFrame, samples: int = 5) -> DataFrame:
    rows = with_properties(log, {"link_type": "Link_Type", "label": "Link_label"})
    # Counts per (type, label) feed both the totals and the samples.
    per_label = rows.groupBy("link_type", "label").agg(F.count("*").alias("n"))
    totals = per_label.groupBy("link_type").agg(F.sum("n").alias("event_count"))
    labels = smallest_values(per_label, ["link_type"], "label", "sample_labels", samples)
    return top(totals.join(labels, "link_type", "left"), "event_count", ["link_type"])


def link_type_by_component(log: DataFrame, k: int = 50) -> DataFrame:
    rows = with_properties(log, {"link_type": "Link_Type", "component": "ComponentName"})
    counts = rows.groupBy("link_type", "component").agg(F.count("*").alias("event_count"))
    return top(counts, "event_count", ["link_type", "component"], k)


def top_pages(log: DataFrame, k: int = 50, approx: bool = False) -> DataFrame:
    rows = with_properties(log, {"page_url": "PageURL"}, ["user_Id"])
    counts = rows.groupBy("page_url").agg(
        F.count("*").alias("event_count"), _distinct("user_Id", approx).alias("unique_users")
    )
    return top(counts, "event_count", ["page_url"], k)


def frequent_pages(log: DataFrame, k: int = 50, approx: bool = False) -> DataFrame:
    """``top_pages`` for pages of any number: visitors are told apart for the pages shown alone."""
    rows = with_properties(log, {"page_url": "PageURL"}, ["user_Id"])
    shown = materialize(most_frequent(rows, ["page_url"], k), "frequent-pages")
    visits = rows.join(shown.alias("shown"), F.col("shown.page_url").eqNullSafe(rows["page_url"]))
    visitors = visits.groupBy("shown.page_url", "event_count").agg(_distinct("user_Id", approx).alias("unique_users"))
    return top(visitors, "event_count", ["page_url"])


def frequent_links(log: DataFrame, k: int = 50) -> DataFrame:
    """The link addresses clicked most, per type of link."""
    rows = with_properties(log, {"link_type": "Link_Type", "address": "Link_address"})
    return most_frequent(rows, ["link_type", "address"], k)


def sites(log: DataFrame, approx: bool = False) -> DataFrame:
    rows = with_properties(log, {"site_name": "SiteName", "page_url": "PageURL"}, ["user_Id"])
    counts = rows.groupBy("site_name").agg(
        F.count("*").alias("event_count"),
        _distinct("user_Id", approx).alias("unique_users"),
        _distinct("page_url", approx).alias("unique_pages"),
    )
    return top(counts, "event_count", ["site_name"])


def content_by_link_type(log: DataFrame, k: int = 50) -> DataFrame:
    rows = with_properties(log, {"content_type": "ContentType", "link_type": "Link_Type"})
    counts = rows.groupBy("content_type", "link_type").agg(F.count("*").alias("event_count"))
    return top(counts, "event_count", ["content_type", "link_type"], k)


def link_domains(log: DataFrame, k: int = 30, approx: bool = False) -> DataFrame:
    rows = with_properties(log, {"address": "Link_address"})
    counts = rows.groupBy(link_host(F.col("address")).alias("domain")).agg(
        F.count("*").alias("event_count"), _distinct("address", approx).alias("unique_links")
    )
    return top(counts, "event_count", ["domain"], k)


def file_types(log: DataFrame, samples: int = 3, approx: bool = False) -> DataFrame:
    wanted = {"file_type": "FileType_Label", "file_name": "FileName_Label"}
    rows = with_properties(log, wanted, ["user_Id"]).where(F.col("file_type") != "")
    counts = rows.groupBy("file_type").agg(
        F.count("*").alias("event_count"), _distinct("user_Id", approx).alias("unique_users")
    )
    names = smallest_values(rows, ["file_type"], "file_name", "sample_files", samples)
    return top(counts.join(names, "file_type", "left"), "event_count", ["file_type"])


def daily_trend(log: DataFrame) -> DataFrame:
    day = F.date_trunc("DAY", F.col("timestamp"))
    return log.groupBy(day.alias("day")).agg(F.count("*").alias("daily_events")).orderBy("day")


# Profiled field -> (property key, size of the value sample or 0, wants distinct count).
PROFILED = {
    "video_action": ("Video_Action", 20, False),
    "video_type": ("Video_Type", 20, False),
    "video_duration": ("Video_Duration", 10, False),
    "topic": ("Topic", 30, True),
    "theme": ("Theme", 30, True),
    "target_org": ("TargetOrganisation", 20, True),
    "target_region": ("TargetRegion", 20, True),
    "ref_uri": ("refUri", 0, False),
}
FILL_RATES = {
    "has_video": "video_action",
    "has_topic": "topic",
    "has_theme": "theme",
    "has_target_org": "target_org",
    "has_target_region": "target_region",
    "has_ref_uri": "ref_uri",
}
ACTED_VIDEO = "acted_video"


def field_profile(log: DataFrame) -> DataFrame:
    """Value samples, cardinality and fill counts of several fields, in one row.

    The fields are unpivoted and counted per (field, value), which is combined on the map side; samples,
    distinct counts and fill counts are all read off that one small table. Samples are the smallest
    values in order.
    """
    keys = {alias: key for alias, (key, _, _) in PROFILED.items()} | {ACTED_VIDEO: "Video_Id"}
    # A field that is only counted as filled or not needs no values, which may be many (addresses).
    counted_only = [f for f, (_, size, distinct) in PROFILED.items() if not size and not distinct]
    rows = with_properties(log, keys).withColumns(
        {ACTED_VIDEO: F.when(F.col("video_action") != "", F.col(ACTED_VIDEO))}
        | {f: F.when(F.col(f) != "", "filled").otherwise("") for f in counted_only}
    )
    long = rows.select(
        F.explode(
            F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in keys])
        ).alias("pair")
    ).select("pair.field", "pair.value")
    per_value = (
        long.where(F.col("value").isNotNull())
        .groupBy("field", "value")
        .agg(F.count("*").alias("n"))
    )
    most = max(size for _, size, _ in PROFILED.values())
    samples = smallest_values(per_value, ["field"], "value", "sample", most)
    sizes = per_value.groupBy("field").agg(
        F.count("*").alias("distinct_values"),
        F.sum("n").alias("total"),
        F.sum(F.when(F.col("value") != "", F.col("n")).otherwise(0)).alias("filled"),
    )
    # One row per field from here on.
    per_field = sizes.join(samples, "field", "left")

    def of(field: str, column: str) -> Column:
        return F.max(F.when(F.col("field") == field, F.col(column)))

    def counted(field: str, column: str) -> Column:
        return F.coalesce(of(field, column), F.lit(0))

    def sample_of(field: str, size: int) -> Column:
        return F.slice(of(field, "sample"), 1, size).alias(f"{field}_values")

    return per_field.agg(
        *[sample_of(f, size) for f, (_, size, _) in PROFILED.items() if size],
        counted(ACTED_VIDEO, "distinct_values").alias("video_action_count"),
        *[counted(f, "distinct_values").alias(f"{f}_distinct") for f, (_, _, d) in PROFILED.items() if d],
        counted("topic", "total").alias("total"),
        *[counted(field, "filled").alias(name) for name, field in FILL_RATES.items()],
    )


def raw_sample(log: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` events by time, with their property bag."""
    columns = ["timestamp", "name", "user_Id", "session_Id", "client_CountryOrRegion"]
    first = log.select(*columns, DETAILS).orderBy(*columns, DETAILS).limit(k)
    return first.select(*columns, property_bag().alias("properties"))


