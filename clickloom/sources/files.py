"""Dated export files: listing in processing order, change detection, reading as text columns."""

from __future__ import annotations

import csv
from collections.abc import Collection, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from clickloom.functions import parse_export_time
from clickloom.schema import EXPORT_RENAMES, quoted
from clickloom.session import materialize

# Size of the pieces that a file's fingerprint is made of, and lines hashed together in them.
BLOCK_BYTES = 64 * 1024 * 1024
RUN_LINES = 4096
# Files are opened again until their change time lies so many seconds before they were recorded.
SETTLED_SECONDS = 10
FILE, RANK, BEYOND = "__file", "__rank", "__beyond"
TIME = "timestamp"
DATE_LIKE = r"^\s*(\d{2}[./]\d{2}[./]\d{4}|\d{4}-\d{2}-\d{2})"
DATE_BYTES = 10
# monotonically_increasing_id() keeps the row of a partition in its lower 33 bits.
ROW_BITS = (1 << 33) - 1


@dataclass(frozen=True)
class Export:
    """A file to load. ``rank`` is its place in processing order, ``header`` its column names.

    ``in_one_piece``: with fields that span lines, hence not to be split.
    """

    path: str
    uri: str
    filename: str
    length: int
    modified: datetime
    date_suffix: date | None
    file_hash: str
    header: tuple[str, ...]
    reason: Literal["new", "changed", "forced"]
    rank: int
    in_one_piece: bool


def date_suffix(filename: Column) -> Column:
    """Date from a ``_YYYY_MM_DD`` ending before the extension; NULL if absent or no real date."""
    digits = F.regexp_extract(filename, r"_(\d{4}_\d{2}_\d{2})(\.[^.]*)?$", 1)
    return F.try_to_timestamp(F.nullif(digits, F.lit("")), F.lit("yyyy_MM_dd")).cast("date")


def list_exports(spark: SparkSession, location: str | Sequence[str]) -> DataFrame:
    """CSV files of a folder (or the given files), oldest date first, undated ones last by change time."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .load(location if isinstance(location, str) else list(location))
    )
    return found.select(
        "path",
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_name").alias("filename"),
        F.col("modificationTime").alias("modified"),
        "length",
        date_suffix(F.col("_metadata.file_name")).alias("date_suffix"),
    ).orderBy(F.col("date_suffix").asc_nulls_last(), "modified", "filename")


@contextmanager
def _fixed_blocks(spark: SparkSession) -> Iterator[None]:
    """While this holds, plans cut every file at multiples of BLOCK_BYTES, whatever else they read."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for name in names:
        spark.conf.set(name, str(BLOCK_BYTES))
    try:
        yield
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def fingerprints(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Per file: a SHA-256 tree over its bytes, its first line, and lines with an open quote.

    Files of any size are read in splits of one size, cut at line feeds alone, so carriage returns are part of
    the lines and every byte counts (whether a last line feed is there shows in the file's length). The leaves
    are lines; runs of RUN_LINES of them, the runs of a split and the splits of a file are hashed in turn, each
    in order. Without a line that has oddly many quotes, or quotes beside a carriage return inside it, no
    field spans lines. One line must fit in memory.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS))
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        "value",
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block"),
        row.alias("row"),
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    open_quotes = (quotes % 2 == 1) | ((quotes > 0) & F.rtrim(F.col("value"), F.lit("\r")).contains("\r"))
    leaf = F.unhex(F.sha2(F.col("value").cast("binary"), 256))

    def hashed(parts: str, order: str) -> Column:
        """SHA-256 of the digests in ``parts`` in their order."""
        listed = F.transform(F.array_sort(F.collect_list(F.struct(order, parts))), lambda p: F.hex(p[parts]))
        return F.unhex(F.sha2(F.array_join(listed, "").cast("binary"), 256))

    # A split is a partition of its own (see _fixed_blocks), so rows are counted from its start.
    runs = (
        lines.select("uri", "block", "row", leaf.alias("leaf"), open_quotes.cast("long").alias("odd"), F.when(F.col("row") == 0, F.col("value")).alias("line"))
        .groupBy("uri", "block", F.floor(F.col("row") / RUN_LINES).alias("run"))
        .agg(hashed("leaf", "row").alias("digest"), F.sum("odd").alias("odd"), F.max("line").alias("line"))
    )
    blocks = runs.groupBy("uri", "block").agg(
        hashed("digest", "run").alias("digest"), F.sum("odd").alias("odd"), F.max("line").alias("line")
    )
    return blocks.groupBy("uri").agg(
        F.lower(F.hex(hashed("digest", "block"))).alias("lines_hash"),
        F.rtrim(F.max(F.when(F.col("block") == 0, F.col("line"))), F.lit("\r")).alias("first_line"),
        F.sum("odd").alias("open_quotes"),
    )


def unique_names(record: Sequence[str | None]) -> tuple[str, ...]:
    """Column names of a header record; a name repeated (ignoring case) gets a number."""
    seen: dict[str, int] = {}
    names = []
    for name in record:
        name = (name or "").removeprefix("\ufeff")
        count = seen.get(name.lower(), 0)
        seen[name.lower()] = count + 1
        names.append(f"{name}_{count}" if count else name)
    return tuple(names)


def header_of(spark: SparkSession, path: str, first_line: str, spanning: bool) -> tuple[str, ...]:
    """Column names of a file; a header with a field that spans lines is read as the record it is."""
    if spanning and first_line.count('"') % 2:
        record = list(spark.read.option("multiLine", True).option("escape", '"').csv(path).first())
        record[-1] = (record[-1] or "").rstrip("\r")
    else:
        record = next(csv.reader([first_line]))
    return unique_names(record)


def pending(
    spark: SparkSession, location, manifest: DataFrame | None, force: bool = False, verify_all: bool = False
) -> list[Export]:
    """Files that are new or whose content changed, in processing order; all of them with ``force``.

    The listing is joined with the manifest; only files it does not know, with another length or change time,
    or changed just before they were recorded, are opened and hashed (all of them with ``verify_all``: a copy
    that keeps length and time looks like the file recorded), and only these come to the driver.
    """
    listed = list_exports(spark, location)
    if manifest is None or force:
        known = listed.withColumn("known_hash", F.lit(None).cast("string"))
        suspects = known
    else:
        before = manifest.select(
            F.col("filename").alias("__name"),
            F.col("file_hash").alias("known_hash"),
            F.col("length").alias("known_length"),
            F.col("modified").alias("known_time"),
            F.col("processed_at").alias("known_at"),
        )
        known = listed.join(before, listed["filename"] == before["__name"], "left")
        same = (F.col("length") == F.col("known_length")) & (F.col("modified") == F.col("known_time"))
        same = same & (F.unix_micros("modified") < F.unix_micros("known_at") - SETTLED_SECONDS * 1_000_000)
        suspects = known if verify_all else known.where(~F.coalesce(same, F.lit(False)))
    order = [F.col("date_suffix").asc_nulls_last(), "modified", "filename"]
    found = suspects.orderBy(*order).collect()
    if not found:
        return []
    with _fixed_blocks(spark):
        prints = {r.uri: r for r in fingerprints(spark, [r.path for r in found]).collect()}

    out = []
    for rank, row in enumerate(found):
        seen = prints.get(row.uri)  # an empty file has no lines
        file_hash = f"{row.length}:{seen.lines_hash if seen else ''}"
        if row.known_hash == file_hash:
            continue
        reason = "forced" if force else ("changed" if row.known_hash is not None else "new")
        spanning = bool(seen and seen.open_quotes)
        header = header_of(spark, row.path, seen.first_line, spanning) if seen and seen.first_line else ()
        out.append(
            Export(
                row.path, row.uri, row.filename, row.length, row.modified, row.date_suffix, file_hash, header,
                reason, rank, spanning,
            )
        )
    return out


def _read_group(spark: SparkSession, paths: list[str], header: Sequence[str], spanning: bool):
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*header, BEYOND]])
    text = (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", spanning)
        .csv(paths)
    )
    if spanning and header:  # read whole, a line's end may leave its carriage return in the last field
        text = text.withColumn(header[-1], F.regexp_replace(quoted(header[-1]), "\r$", ""))
    # An empty field is a missing value, whether quoted or not.
    return text.select(
        *[F.nullif(quoted(name), F.lit("")).alias(name) for name in [*header, BEYOND]],
        F.col("_metadata.file_path").alias(FILE),
    )


def read_exports(spark: SparkSession, exports: Sequence[Export]) -> DataFrame:
    """Rows of all files as text columns, plus the file, its rank, and a field beyond the header if a row has one.

    Files are read together per header, and headers are united by name. A field may span lines: only files
    with such fields are parsed whole, each by one task.
    """
    groups: dict[tuple, list[str]] = {}
    for e in exports:
        groups.setdefault((e.header, e.in_one_piece), []).append(e.path)
    parts = [_read_group(spark, paths, h, whole) for (h, whole), paths in groups.items()]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    ranks = spark.createDataFrame([(e.uri, e.rank) for e in exports], f"{FILE} string, {RANK} int")
    return materialize(rows.withColumnsRenamed(EXPORT_RENAMES).join(ranks, FILE), "delivered")


def is_time(value: Column) -> Column:
    """Whether a text is a time in an accepted spelling; parsing is tried only on what begins like a date.

    Texts shorter than a date are told by their length alone.
    """
    like = (F.octet_length(value) >= DATE_BYTES) & value.rlike(DATE_LIKE)
    return F.coalesce(F.when(like, parse_export_time(value)).isNotNull(), F.lit(False))


@dataclass(frozen=True)
class Delivered:
    """What a batch of files holds: rows and rows without a usable time per file, filled values and times per column."""

    rows: dict[str, int]
    timeless: int
    filled: dict[str, int]
    times: dict[str, int]


def profile(rows: DataFrame, settled: Collection[str] = ()) -> Delivered:
    """One pass over the rows of ``read_exports``; times are not looked for in the ``settled`` columns.

    Raises ValueError when a row has more fields than its header.
    """
    texts = [c for c in rows.columns if c not in (FILE, RANK, BEYOND)]
    wanted = [c for c in texts if c.lower() not in settled]
    counts = rows.groupBy(FILE).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(BEYOND).alias("beyond"),
        F.array(*[F.count(quoted(c)) for c in texts]).alias("filled"),
        F.array(*[F.count_if(is_time(quoted(c))) for c in wanted], F.lit(0).cast("long")).alias("times"),
    )
    per_file = counts.collect()  # one row per file
    wide = sorted(r[FILE] for r in per_file if r.beyond)
    if wide:
        raise ValueError(f"rows with more fields than the header: {', '.join(wide)}")
    filled = {c: sum(r.filled[i] for r in per_file) for i, c in enumerate(texts)}
    times = {c: sum(r.times[i] for r in per_file) for i, c in enumerate(wanted)}
    n = {r[FILE]: r.n for r in per_file}
    return Delivered(n, sum(n.values()) - times.get(TIME, 0), filled, times)


def time_quality(rows: DataFrame, column: str = "timestamp") -> DataFrame:
    """Loaded rows, those without a usable time, and those whose time has a fraction of a second."""
    micros = F.unix_micros(quoted(column)) % 1_000_000
    return rows.agg(
        F.count("*").alias("total"),
        F.count_if(quoted(column).isNull()).alias("without_time"),
        F.count_if(micros != 0).alias("with_fraction"),
    )
