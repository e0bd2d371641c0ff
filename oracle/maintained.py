"""Derived tables kept up over two deliveries: everything before October first, then the rest."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.operators.flatten import key_inventory, with_properties
from clickloom.plans import enrich, explore, sketches, star, video
from clickloom.plans.ingest import ingest_log
from clickloom.plans.maintain import (
    fact_table, key_registry, on_dates, session_table, update_facts, update_sessions,
)
from clickloom.session import materialize, scratch_dir
from clickloom.sources.log import log_table, recent_log, store_log
from clickloom.sources.store import EventStore
from clickloom.streaming.log_stream import log_files, stream_log
from oracle import bindings
from oracle.views import PEPPER

CUT = "2024-10-01"
# Rows of the streamed log that one file holds.
FILE_ROWS = 250_000
AS_OF = datetime(2025, 1, 1)


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich(bindings.click_events(spark, sf_dir), bindings.hr(spark, sf_dir))


def _video_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What video metrics read of the events: no gaps, no organisation, no times as texts."""
    events = enrich.with_session_columns(bindings.click_events(spark, sf_dir))
    return events.select("timestamp", "session_date", "gpn", "session_id", *[c for c in events.columns if c.startswith("CP_Video_")])


def _steps(spark: SparkSession, sf_dir: str, events=_enriched) -> tuple[str, DataFrame, DataFrame, list]:
    """A folder, the events of the first step, those of both, and the local dates that the second step changes."""
    every = materialize(events(spark, sf_dir), "events")
    first = F.col("session_date") < CUT
    dates = [r.session_date for r in every.where(~first).select("session_date").distinct().collect()]
    return f"{scratch_dir(spark).rstrip('/')}/maintained-{uuid.uuid4().hex}", every.where(first), every, dates


def stable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every natural key with its number, and whether it had that number after the first step already."""
    out, first, every, dates = _steps(spark, sf_dir)
    registry = key_registry(spark, out)
    before = registry.register(star.natural_keys(first, list(star.NATURAL_KEYS)))
    before = materialize(before.withColumn("kept", F.lit(True)), "before")
    after = registry.register(star.natural_keys(on_dates(every, dates), list(star.NATURAL_KEYS)))
    told = after.join(before, ["dim", "parts", "number"], "left")
    key = F.array_join("parts", "|", "")
    return told.select("dim", key.alias("natural_key"), "number", F.coalesce("kept", F.lit(False)).alias("kept"))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts after both steps, with what their keys stand for in place of the keys."""
    out, first, every, dates = _steps(spark, sf_dir)
    table, registry = fact_table(spark, out), key_registry(spark, out)
    update_facts(table, registry, first, None, PEPPER)
    dims = update_facts(table, registry, every, dates, PEPPER)
    facts = table.read()
    for dim, key in (
        (dims.dim_date.select("date_key", "date_value"), "date_key"),
        (dims.dim_organization.select("org_key", "org_hash"), "org_key"),
        (dims.dim_site, "site_key"),
        (dims.dim_page, "page_key"),
        (dims.dim_link_type, "link_type_key"),
        (dims.dim_component, "component_key"),
    ):
        facts = facts.join(dim, key, "left").drop(key)
    return facts.drop("session_date")


def engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video engagement after both steps; the second reads the sessions it reaches and no others."""
    out, first, every, dates = _steps(spark, sf_dir, _video_columns)
    table = session_table(spark, out)
    update_sessions(table, first, None)
    return video.engagement_of_sessions(update_sessions(table, every, dates))


def _log(spark: SparkSession, sf_dir: str):
    """The log stored by day in two steps: all days, then the rows from the cut on once more in place of theirs."""
    table = log_table(spark, f"{scratch_dir(spark).rstrip('/')}/log-{uuid.uuid4().hex}")
    rows = bindings.raw_log(spark, sf_dir)
    store_log(table, rows.where(F.col("timestamp") < CUT))
    yield table
    store_log(table, rows.where((F.col("timestamp") >= CUT) & (F.col("event_id") % 2 == 0)))
    store_log(table, rows.where((F.col("timestamp") >= CUT) & (F.col("event_id") % 2 == 1)))
    yield table


def log_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that came through the stored log: a first run, and one for the days that came since."""
    store = EventStore(spark, f"{scratch_dir(spark).rstrip('/')}/events-{uuid.uuid4().hex}")
    for table in _log(spark, sf_dir):
        ingest_log(store, table)
    return _told(store)


def _stream_files(rows: DataFrame) -> int:
    """Four files, or as many times four as the rows need."""
    return 4 * max(1, -(-rows.count() // (4 * FILE_ROWS)))


def log_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events, streamed in two micro-batches, from four files while these are of moderate size."""
    root = f"{scratch_dir(spark).rstrip('/')}/streamed-{uuid.uuid4().hex}"
    rows = bindings.raw_log(spark, sf_dir)
    files = _stream_files(rows)
    rows.repartition(files, "event_id").write.parquet(f"{root}/files")
    store, table = EventStore(spark, f"{root}/events"), log_table(spark, f"{root}/log")
    stream_log(log_files(spark, f"{root}/files", rows.schema, files // 2), table, store, f"{root}/checkpoint", f"log-{uuid.uuid4().hex}")
    return _told(store)


def _told(store: EventStore) -> DataFrame:
    named = {"label": "CP_Link_label", "gpn": "CP_GPN", "other_gpn": "CP_gpn_1", "owner": "CP_ContentOwner"}
    return store.events().select("timestamp", "user_id", "session_id", "name", *[F.col(c).alias(a) for a, c in named.items()])


def recent_from_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend of the last 90 days, from the folders of these days."""
    *_, table = _log(spark, sf_dir)
    return explore.daily_trend(recent_log(table, AS_OF, 90))


def _sketches(spark: SparkSession, sf_dir: str):
    tables = sketches.sketch_tables(spark, f"{scratch_dir(spark).rstrip('/')}/sketches-{uuid.uuid4().hex}")
    clicks = bindings.raw_log(spark, sf_dir).where(F.col("name") == "click_event")
    since = F.to_date("timestamp") >= CUT
    sketches.update(tables, clicks.where(~since), None, PEPPER)
    late = [r.d for r in clicks.where(since).select(F.to_date("timestamp").alias("d")).distinct().collect()]
    sketches.update(tables, clicks.where(since), late, PEPPER)
    return clicks, tables


FROM, TO = date(2024, 8, 15), date(2024, 11, 30)


def visits_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact counts of a range of days, and whether the united sketches come within 5 %."""
    clicks, (table, _) = _sketches(spark, sf_dir)
    told = sketches.visits(table, FROM, TO)
    within = clicks.where(F.to_date("timestamp").between(FROM, TO))
    people = with_properties(within, {"gpn": "GPN"}, ["user_Id", "session_Id", "client_CountryOrRegion"])
    exact = people.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("user_Id").alias("n_users"),
        F.count_distinct("session_Id").alias("n_sessions"),
        F.count_distinct("gpn").alias("n_gpns"),
        F.count_distinct("client_CountryOrRegion").alias("n_countries"),
    )
    both = told.join(exact, F.col("total_events") == F.col("n"))
    near = {c: F.abs(F.col(c) - F.col(f"n_{c}")) <= 0.05 * F.col(f"n_{c}") for c in ("users", "sessions", "gpns", "countries")}
    return both.select(
        "total_events", "first_event", "last_event", *[f"n_{c}" for c in near], *[flag.alias(f"{c}_close") for c, flag in near.items()]
    )


def property_values_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks, (_, table) = _sketches(spark, sf_dir)
    told = sketches.property_values(table, FROM, TO).withColumnRenamed("distinct_values", "estimate")
    within = clicks.where(F.to_date("timestamp").between(FROM, TO))
    exact = key_inventory(within).select("key", "distinct_values")
    close = F.abs(F.col("estimate") - F.col("distinct_values")) <= F.lit(0.05) * F.col("distinct_values")
    return told.join(exact, "key").select("key", "key_count", "sample_value", "distinct_values", close.alias("close"))
