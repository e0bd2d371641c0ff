"""Incremental ingest: find changed export files, merge them into the event store, record them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime
from typing import Literal

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.functions import parse_export_time
from clickloom.operators.flatten import CLICK_EVENT, export_view, flatten
from clickloom.operators.upsert import upsert
from clickloom.schema import EXPORT_RENAMES, quoted
from clickloom.session import materialize
from clickloom.sources import files
from clickloom.sources.log import stored_days
from clickloom.sources.parts import PartitionedTable
from clickloom.sources.store import MANIFEST, TIME, TIME_TEXT, ColumnKind, EventStore, Version, updated_manifest

Mode = Literal["delta", "full_refresh", "file"]
LOG = "log/"  # days of the log in the manifest


@dataclass(frozen=True)
class Ingested:
    version: Version
    files: dict[str, str]  # name -> reason
    row_counts: dict[str, int]
    without_time: int  # rows whose time is missing or in no accepted spelling
    widened: list[str]  # columns of times that are texts from this version on


def ingest(
    spark: SparkSession,
    store: EventStore,
    location: str,
    mode: Mode = "delta",
    date_columns: Sequence[str] | None = None,
    verify_all: bool = False,
) -> Ingested | None:
    """Load what is pending at ``location`` and commit a new version; None when nothing is.

    ``delta`` takes new and changed files of a folder, ``file`` one file whatever the manifest says, and
    ``full_refresh`` all files into an empty store. All files are merged in one pass, later files winning
    over earlier ones, and only the UTC days they touch are rewritten (the time is part of the key).
    A column is a time while all values ever delivered in it are; with the first other value it becomes a text,
    for the rows stored before as well. ``date_columns`` declares columns to be times whatever they hold.
    ``verify_all`` hashes every file again, also those whose length and change time are as recorded.
    """
    refresh = mode == "full_refresh"
    known = store.processed_files()
    exports = files.pending(
        spark, location, None if refresh else known, mode in ("full_refresh", "file"), verify_all
    )
    if not exports:
        if refresh or not files.list_exports(spark, location).take(1):
            raise FileNotFoundError(f"no export files at {location}")
        return None

    staged = files.read_exports(spark, exports)
    if len(exports) == 1:
        staged = staged.drop(files.RANK)
    entries = [Entry(e.filename, e.uri, e.file_hash, e.reason, e.date_suffix, e.length, e.modified) for e in exports]
    return _load(store, staged, entries, refresh, date_columns)


@dataclass(frozen=True)
class Entry:
    """What the manifest keeps of a file (or day of the log) that is loaded; ``source`` marks its rows."""

    filename: str
    source: str
    file_hash: str
    reason: str
    date_suffix: date | None = None
    length: int | None = None
    modified: datetime | None = None


def _load(
    store: EventStore, staged: DataFrame, entries: Sequence[Entry], refresh: bool, date_columns: Sequence[str] | None
) -> Ingested:
    """Merge rows of texts into the store and commit a new version.

    Rows are marked by source, and by rank where one delivery may replace rows of another.
    """
    spark, known = store.spark, store.processed_files()
    target_version = store.next(refresh)
    current = store.current()
    has_target = not refresh and current.number > 0
    columns = store.columns(current) if has_target else {}
    settled = {name for name, c in columns.items() if c.kind == "text" or name == TIME_TEXT}
    delivered = files.profile(staged, settled)
    row_counts = {e.filename: delivered.rows.get(e.source, 0) for e in entries}
    kinds = widened(columns, delivered, date_columns or ())

    batch = with_event_time(staged.drop(files.FILE, files.BEYOND))
    days = [r.day for r in batch.select(F.to_date(TIME).alias("day")).distinct().collect()]
    target = store.stored(current, days) if has_target else None
    merged = upsert(target, batch, rank=files.RANK if files.RANK in batch.columns else None)
    store.write_days(merged, target_version)

    processed = spark.createDataFrame(
        [(e.filename, e.file_hash, row_counts[e.filename], None, e.date_suffix, e.length, e.modified) for e in entries],
        MANIFEST,
    ).withColumn("processed_at", F.current_timestamp())
    before = known.limit(0) if refresh else known
    store.commit(target_version, merged.schema, kinds.values(), updated_manifest(before, processed))
    texts = [c.name for name, c in kinds.items() if c.kind == "text" and name in columns and columns[name].kind == "time"]
    reasons = {e.filename: e.reason for e in entries}
    return Ingested(target_version, reasons, row_counts, delivered.timeless, texts)


def ingest_log(
    store: EventStore, log: PartitionedTable, name: str = CLICK_EVENT, date_columns: Sequence[str] | None = None
) -> Ingested | None:
    """Bring events of the stored log into the store: the other way than by export files, with the same result.

    Days that the manifest does not know, or that were written again since, are flattened and merged; only their
    folders are opened. None when there are none. As in an export, an empty property is a missing value.
    """
    known = {r.filename: r.file_hash for r in store.processed_files().where(F.col("filename").startswith(LOG)).collect()}
    found = {f"{LOG}{day}": (day, str(version)) for day, version in stored_days(log).items()}
    entries = [
        Entry(filename, filename, version, "changed" if filename in known else "new", day)
        for filename, (day, version) in sorted(found.items())
        if known.get(filename) != version
    ]
    if not entries:
        return None
    rows = log.read(values=[e.date_suffix for e in entries]).where(F.col("name") == name)
    day = F.to_date("timestamp").cast("string")
    flat = flatten(rows).withColumn(files.FILE, F.concat(F.lit(LOG), F.coalesce(day, F.lit("None"))))
    exported = export_view(flat).withColumnsRenamed(EXPORT_RENAMES)
    texts = exported.select(*[F.nullif(quoted(c), F.lit("")).alias(c) for c in exported.columns])
    # The days are one delivery: a key holds the time, so none of them has rows of another.
    marked = texts.withColumn(files.BEYOND, F.lit(None).cast("string"))
    return _load(store, materialize(marked, "delivered-log"), entries, False, date_columns)


def with_event_time(rows: DataFrame) -> DataFrame:
    """The event time parsed; its text stays beside it where it is in no accepted spelling."""
    if TIME not in rows.columns:
        raise ValueError(f"no column {TIME} in the export files")
    parsed = parse_export_time(F.col(TIME))
    text = F.when(parsed.isNull(), F.col(TIME))
    return rows.withColumns({TIME_TEXT: text, TIME: parsed})


def widened(columns: dict[str, ColumnKind], delivered: files.Delivered, declared: Sequence[str]) -> dict[str, ColumnKind]:
    """The columns known so far, with what was delivered in them added, and the new ones."""
    kinds = dict(columns)
    for name, filled in delivered.filled.items():
        known = kinds.get(name.lower(), ColumnKind(name))
        kinds[name.lower()] = known.with_values(filled, delivered.times.get(name, 0))
    for name in {TIME, *(d.lower() for d in declared)} & kinds.keys():
        kinds[name] = replace(kinds[name], declared=True)
    return kinds
