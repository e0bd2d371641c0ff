"""Accumulated raw events and the manifest of processed files, as versioned Parquet folders.

    <root>/generation=G/data/version=N/event_date=D/   rows of one UTC day as of version N
    <root>/generation=G/commits/version=N/schema       stored columns of the table as of version N
    <root>/generation=G/commits/version=N/columns      the kind of each column as of version N
    <root>/generation=G/commits/version=N/days         (day, version): where the rows of each day lie
    <root>/generation=G/commits/version=N/manifest     processed files; written last, commits the version

A version only writes the days its deliveries touch; its commit names the folder of every day.
Readers see a version once its manifest is complete, so a run that dies leaves the store as it was, and
rows are never replaced in place. A full refresh starts a new generation.

Values are stored as the texts that were delivered; only the event time is stored as a time (and its text beside
it where it is none). What a column *is* stands in the commit: a time while every value so far was one, a text
from the first other value on. Readers see columns of that kind, so a column that widens needs no day
rewritten and loses nothing.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import date
from typing import Literal

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clickloom.functions import parse_export_time
from clickloom.schema import quoted

MANIFEST = (
    "filename string, file_hash string, row_count int, processed_at timestamp, date_suffix date, "
    "length long, modified timestamp"
)
COLUMNS = "name string, kind string, filled long, times long, declared boolean"
DAYS = "day string, version int"
DAY = "event_date"
TIME, TIME_TEXT = "timestamp", "__timestamp_text"
NO_DAY = f"{DAY}=__HIVE_DEFAULT_PARTITION__"


def day_folder(day: date | None) -> str:
    return NO_DAY if day is None else f"{DAY}={day.isoformat()}"


def folder_day(name: str) -> date | None:
    return None if name == NO_DAY else date.fromisoformat(name.removeprefix(f"{DAY}="))


@dataclass(frozen=True)
class ColumnKind:
    """``filled`` values were delivered in a column, ``times`` of them times in an accepted spelling.

    Times are counted as long as the column may still be one. A ``declared`` column is a time whatever it
    holds; its other values read as NULL and stay in the stored text.
    """

    name: str
    filled: int = 0
    times: int = 0
    declared: bool = False

    @property
    def kind(self) -> Literal["open", "time", "text"]:
        if self.declared:
            return "time"
        if not self.filled:
            return "open"
        return "time" if self.times == self.filled else "text"

    def with_values(self, filled: int, times: int) -> ColumnKind:
        return replace(self, filled=self.filled + filled, times=self.times + times)


class Folders:
    """Directory listings on whatever file system the path names."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._open(path)
        return fs.exists(p)

    def remove(self, path: str) -> None:
        fs, p = self._open(path)
        fs.delete(p, True)

    def children(self, path: str) -> list[str]:
        fs, p = self._open(path)
        if not fs.exists(p):
            return []
        return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]

    def numbered(self, path: str, prefix: str) -> list[int]:
        names = [n for n in self.children(path) if n.startswith(prefix)]
        return sorted(int(n.removeprefix(prefix)) for n in names)


@dataclass(frozen=True)
class Version:
    generation: int
    number: int  # 0: nothing committed yet


class EventStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.folders = Folders(spark)

    def _generation(self, generation: int) -> str:
        return f"{self.root}/generation={generation}"

    def _commit(self, v: Version) -> str:
        return f"{self._generation(v.generation)}/commits/version={v.number}"

    def _data(self, v: Version) -> str:
        return f"{self._generation(v.generation)}/data/version={v.number}"

    def current(self) -> Version:
        """The newest committed version of the newest generation that has one."""
        for generation in reversed(self.folders.numbered(self.root, "generation=")):
            commits = f"{self._generation(generation)}/commits"
            for number in reversed(self.folders.numbered(commits, "version=")):
                if self.folders.exists(f"{commits}/version={number}/manifest/_SUCCESS"):
                    return Version(generation, number)
        return Version(1, 0)

    def next(self, refresh: bool = False) -> Version:
        """A version number no earlier run has used, not even one that failed."""
        now = self.current()
        if refresh:
            taken = self.folders.numbered(self.root, "generation=")
            return Version(max(taken, default=0) + 1, 1)
        base = self._generation(now.generation)
        taken = self.folders.numbered(f"{base}/data", "version=")
        taken += self.folders.numbered(f"{base}/commits", "version=")
        return Version(now.generation, max(taken, default=0) + 1)

    def _days(self, v: Version) -> dict[str, int]:
        """Day folder -> version that wrote it, as the commit names them."""
        if not v.number:
            return {}
        return dict(map(tuple, self.spark.read.schema(DAYS).parquet(f"{self._commit(v)}/days").collect()))

    def _day_paths(self, v: Version) -> dict[str, str]:
        return {day: f"{self._data(Version(v.generation, n))}/{day}" for day, n in self._days(v).items()}

    def schema(self, v: Version) -> T.StructType:
        text = self.spark.read.text(f"{self._commit(v)}/schema").first().value
        return T.StructType.fromJson(json.loads(text))

    def columns(self, version: Version | None = None) -> dict[str, ColumnKind]:
        """The columns of a version by lower-case name."""
        v = version or self.current()
        if v.number == 0:
            return {}
        rows = self.spark.read.schema(COLUMNS).parquet(f"{self._commit(v)}/columns").collect()
        return {r.name.lower(): ColumnKind(r.name, r.filled, r.times, r.declared) for r in rows}

    def column_report(self, version: Version | None = None) -> DataFrame:
        """Per column its kind, the values delivered, those that were times, and those it cannot show."""
        v = version or self.current()
        if v.number == 0:
            return self.spark.createDataFrame([], f"{COLUMNS}, unusable long")
        unusable = F.when(F.col("kind") == "time", F.col("filled") - F.col("times")).otherwise(0)
        return self.spark.read.schema(COLUMNS).parquet(f"{self._commit(v)}/columns").withColumn("unusable", unusable)

    def events(
        self, version: Version | None = None, days: Iterable[date | None] | None = None
    ) -> DataFrame | None:
        """All rows of a version, or those of some UTC days, in columns of their kinds; None before the first commit."""
        v = version or self.current()
        stored = self.stored(v, days)
        if stored is None:
            return None
        kinds = self.columns(v)

        def shown(field: T.StructField):
            column = quoted(field.name)
            is_text = isinstance(field.dataType, T.StringType)
            known = kinds.get(field.name.lower())
            if is_text and known and known.kind == "time":
                return parse_export_time(column).alias(field.name)
            return column

        return stored.select(*[shown(f) for f in stored.schema.fields if f.name != TIME_TEXT])

    def stored(
        self, version: Version | None = None, days: Iterable[date | None] | None = None
    ) -> DataFrame | None:
        """Rows as stored: delivered texts beside the event time.

        The day folders to read are chosen here, so other days are never listed or opened.
        """
        v = version or self.current()
        if v.number == 0:
            return None
        folders = self._day_paths(v)
        if days is not None:
            wanted = {day_folder(d) for d in days}
            folders = {name: path for name, path in folders.items() if name in wanted}
        schema = self.schema(v)
        if not folders:
            return self.spark.createDataFrame([], schema)
        partitioned = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
        base = f"{self._generation(v.generation)}/data"
        rows = self.spark.read.schema(partitioned).option("basePath", base).parquet(*folders.values())
        return rows.select(*[F.col(f"`{f.name}`") for f in schema.fields])

    def days_changed(self, since: Version | None, until: Version) -> set[date | None] | None:
        """UTC days written after one version up to another; None when everything has to be taken as new.

        That is so when a column has another kind, as this shows on all days.
        """
        if since is None or since.generation != until.generation:
            return None
        if since.number:
            before, after = self.columns(since), self.columns(until)
            if any((before[c].kind == "time") != (after[c].kind == "time") for c in before):
                return None
        return {folder_day(day) for day, number in self._days(until).items() if number > since.number}

    def processed_files(self, version: Version | None = None) -> DataFrame:
        v = version or self.current()
        if v.number == 0:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self._commit(v)}/manifest")

    def processed_report(self) -> DataFrame:
        return self.processed_files().orderBy("date_suffix", "filename")

    def write_days(self, rows: DataFrame, v: Version) -> None:
        """Write rows into their day folders; a large day is spread over several files."""
        dated = rows.withColumn(DAY, F.to_date(TIME))
        balanced = dated.hint("rebalance", DAY)
        balanced.write.partitionBy(DAY).parquet(self._data(v))

    def forget_before(self, v: Version) -> list[str]:
        """Remove earlier generations and versions, but for the day folders that ``v`` still reads; returns what went."""
        gone = [self._generation(g) for g in self.folders.numbered(self.root, "generation=") if g < v.generation]
        base, needed = self._generation(v.generation), set(self._days(v).items())
        for n in self.folders.numbered(f"{base}/data", "version="):
            data = f"{base}/data/version={n}"
            days = self.folders.children(data) if n <= v.number else []
            gone += [f"{data}/{day}" for day in days if day.startswith(f"{DAY}=") and (day, n) not in needed]
        gone += [f"{base}/commits/version={n}" for n in self.folders.numbered(f"{base}/commits", "version=") if n < v.number]
        for path in gone:
            self.folders.remove(path)
        return gone

    def commit(self, v: Version, schema: T.StructType, columns: Iterable[ColumnKind], manifest: DataFrame) -> None:
        rows = [(c.name, c.kind, c.filled, c.times, c.declared) for c in columns]
        before = self.current()
        days = self._days(before) if before.generation == v.generation else {}
        days |= {day: v.number for day in self.folders.children(self._data(v)) if day.startswith(f"{DAY}=")}
        self.spark.createDataFrame(list(days.items()), DAYS).coalesce(1).write.mode("overwrite").parquet(f"{self._commit(v)}/days")
        self.spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("overwrite").parquet(f"{self._commit(v)}/columns")
        text = self.spark.createDataFrame([(schema.json(),)], "value string")
        text.write.mode("overwrite").text(f"{self._commit(v)}/schema")
        manifest.write.mode("overwrite").parquet(f"{self._commit(v)}/manifest")


def updated_manifest(known: DataFrame, processed: DataFrame) -> DataFrame:
    """Known files, those processed now replaced by their new entry."""
    return known.join(processed, "filename", "left_anti").unionByName(processed)
