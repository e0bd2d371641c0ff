"""The batch job: ingest, enrich, aggregate, publish."""

from __future__ import annotations

import hashlib
import hmac
from collections.abc import Collection
from dataclasses import dataclass, fields
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.operators.ordered import HotGroups
from clickloom.plans import profile, star, video
from clickloom.plans.anonymize import anonymize
from clickloom.plans.enrich import enrich
from clickloom.plans.ingest import Ingested, Mode, ingest
from clickloom.plans.maintain import fact_table, key_registry, session_table, update_facts, update_sessions
from clickloom.session import materialize
from clickloom.sources.store import EventStore, Version


@dataclass(frozen=True)
class Options:
    """Readings of the data that differ from the defaults, and how large groups are split."""

    date_columns: tuple[str, ...] | None = None
    verify_all: bool = False
    blank_gpn_is_null: bool = False
    pad_hr_gpn: bool = False
    merge_mode: str = "lag"
    count_first_event: bool = False
    valid_is_no_skip: bool = False
    hot: HotGroups | None = HotGroups()

    def video_rules(self) -> dict[str, object]:
        return {
            "mode": self.merge_mode,
            "count_first_event": self.count_first_event,
            "valid_is_no_skip": self.valid_is_no_skip,
        }

    def events_rules(self) -> dict[str, object]:
        return {"blank_gpn_is_null": self.blank_gpn_is_null, "pad_hr_gpn": self.pad_hr_gpn, "hot": self.hot}

    def digest(self) -> str:
        """Changes when published tables would look different for the same events."""
        return repr((self.blank_gpn_is_null, self.pad_hr_gpn, sorted(self.video_rules().items())))


PUBLISHED = "published"  # one-row table naming the store version the outputs were built from


@dataclass(frozen=True)
class Published:
    ingested: Ingested | None
    tables: dict[str, str]  # name -> path
    reports: dict[str, DataFrame]


def write_table(
    df: DataFrame, path: str, partition_by: str | None = None, replace_all: bool = True
) -> DataFrame:
    """Write as Snappy Parquet and read the table back.

    Replaces the table, or without ``replace_all`` just the partitions that ``df`` has rows for.
    """
    laid_out = df.hint("rebalance", partition_by) if partition_by else df
    writer = (
        laid_out.write.mode("overwrite")
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
    )
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_dates(utc_days: set[date | None]) -> set[date | None]:
    """Local dates that events of the UTC days can fall on (local time is one or two hours ahead)."""
    return {d and d + timedelta(days=n) for d in utc_days for n in (0, 1)}


def write_events(
    store: EventStore,
    version: Version,
    changed: set[date | None] | None,
    hr: DataFrame | None,
    output: str,
    pepper: str,
    options: Options = Options(),
) -> DataFrame:
    """Enrich stored events into ``events_raw`` and ``events_anonymized``, by local date.

    Sessions lie within one local date, so with ``changed`` UTC days given only the dates these reach are
    rebuilt: their raw rows are read, the rest of both tables stays as it is.
    """
    raw_path, safe_path = f"{output}/events_raw", f"{output}/events_anonymized"
    if changed is None:
        stored = write_table(enrich(store.events(version), hr, **options.events_rules()), raw_path, "session_date")
        write_table(anonymize(stored, pepper), safe_path, "session_date")
        return stored
    dates = local_dates(changed)
    needed = dates | {d - timedelta(days=1) for d in dates if d}
    known = [d for d in dates if d]
    rebuilt = F.col("session_date").isin(known) if known else F.lit(False)
    if None in dates:
        rebuilt = rebuilt | F.col("session_date").isNull()
    events = enrich(store.events(version, needed), hr, **options.events_rules())
    stored = write_table(events.where(rebuilt), raw_path, "session_date", replace_all=False)
    safe = anonymize(stored.where(rebuilt), pepper)
    write_table(safe, safe_path, "session_date", replace_all=False)
    return stored


def publish(
    stored: DataFrame,
    output: str,
    pepper: str,
    dates: Collection[date | None] | None = None,
    options: Options = Options(),
    hr: DataFrame | None = None,
) -> tuple[dict[str, str], dict[str, DataFrame]]:
    """Bring the tables derived from enriched events up to date; returns paths and report frames.

    With ``dates`` only events of these local dates (and of the viewing sessions that reach into them) are
    read for video engagement, dimensions and facts. Facts and sessions are written aside, see ``read_fact``.
    """
    spark = stored.sparkSession
    paths = {name: f"{output}/{name}" for name in ("events_raw", "events_anonymized")}

    def put(name: str, df: DataFrame) -> DataFrame:
        paths[name] = f"{output}/{name}"
        return write_table(df, paths[name])

    reports = profile.summary(stored)
    if video.has_video(stored):
        states = update_sessions(session_table(spark, output), stored, dates, options.video_rules(), options.hot)
        engaged = put("video_engagement", video.engagement_of_sessions(states))
        put("video_engagement_anonymized", anonymize(engaged, pepper))
        reports["video_summary"] = video.engagement_summary(engaged)
        reports["video_tiers"] = video.tier_distribution(engaged)
    history = None
    if hr is not None:
        history = materialize(star.organization_history(hr, options.pad_hr_gpn), "organization-history")
        put("cdm/dim_organization_history", anonymize(history, pepper))
    facts, registry = fact_table(spark, output), key_registry(spark, output)
    dims = update_facts(facts, registry, stored, dates, pepper, history)
    for f in fields(dims):
        put(f"cdm/{f.name}", getattr(dims, f.name))
    paths["cdm/fact_event"] = f"{output}/cdm/fact_event"
    return paths, reports


def read_fact(spark: SparkSession, output: str) -> DataFrame | None:
    """The facts of the newest complete version."""
    return fact_table(spark, output.rstrip("/")).read()


def load_hr(spark: SparkSession, path: str | None, store: EventStore) -> DataFrame | None:
    """Organisation snapshots, or None when the table is not there (events then carry no such fields)."""
    if path is None or not store.folders.exists(path):
        return None
    return spark.read.parquet(path)


def inputs_digest(hr: DataFrame | None, pepper: str, options: Options = Options()) -> str:
    """Changes when the snapshots, the key or the options do, which affects events of any day."""
    key = hmac.new(pepper.encode(), b"key check" + options.digest().encode(), hashlib.sha256).hexdigest()
    if hr is None:
        return f"{key}:none"
    row_hash = F.xxhash64(*sorted(hr.columns)).cast("decimal(20,0)")
    total = hr.agg(F.count("*").alias("n"), F.sum(row_hash).alias("hashes")).first()
    return f"{key}:{total.n}:{total.hashes}:{','.join(sorted(hr.columns))}"


def last_published(store: EventStore, output: str, digest: str) -> Version | None:
    """The version the outputs show, if they were built from the same snapshots and key."""
    marker = f"{output}/{PUBLISHED}"
    if not store.folders.exists(f"{marker}/_SUCCESS"):
        return None
    row = store.spark.read.parquet(marker).first()
    return Version(row.generation, row.number) if row.digest == digest else None


def write_marker(store: EventStore, output: str, shown: Version, digest: str) -> None:
    row = (shown.generation, shown.number, digest)
    schema = "generation int, number int, digest string"
    write_table(store.spark.createDataFrame([row], schema), f"{output}/{PUBLISHED}")


def run(
    spark: SparkSession,
    location: str,
    store_root: str,
    output: str,
    pepper: str,
    hr_path: str | None = None,
    mode: Mode = "delta",
    options: Options = Options(),
) -> Published | None:
    """One run over the files at ``location``; None when a delta run finds nothing to do.

    The version that was published is recorded last, and the next run rebuilds the days changed since. A
    run that died between ingest and publishing is therefore made up for, even if no new file has come.
    """
    output = output.rstrip("/")
    store = EventStore(spark, store_root)
    done = ingest(spark, store, location, mode, options.date_columns, options.verify_all)
    version = store.current()
    hr = load_hr(spark, hr_path, store)
    digest = inputs_digest(hr, pepper, options)
    shown = last_published(store, output, digest)
    if done is None and shown == version:
        return None
    changed = store.days_changed(shown, version)
    # Outputs are about to be replaced: until that is complete they show no version at all.
    write_marker(store, output, Version(0, 0), "")
    stored = write_events(store, version, changed, hr, output, pepper, options)
    dates = None if changed is None else local_dates(changed)
    tables, reports = publish(stored, output, pepper, dates, options, hr)
    reports["processed_files"] = store.processed_report()
    reports["columns"] = store.column_report()
    if hr is not None:
        reports["hr_profile"] = profile.hr_profile(hr)
    reports = {name: write_table(report, f"{output}/reports/{name}") for name, report in reports.items()}
    write_marker(store, output, version, digest)
    return Published(done, tables, reports)
