"""Tables whose partitions are replaced aside: a commit names the folder of every partition.

    <root>/data/version=N/<column>=<value>/    partitions written for version N
    <root>/commits/version=N/schema            columns of version N
    <root>/commits/version=N/streams           (stream, batch): the last batch of each stream that is in it
    <root>/commits/version=N/parts             (part, version): where each partition lies; written last

A reader takes the newest complete commit and opens just the folders it names. Nothing a reader may have
opened is ever changed, so it sees a whole table of one version, also while the next one is written. Folders
that no kept version names can be removed with ``forget_before``.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clickloom.schema import quoted
from clickloom.sources.store import Folders

PARTS = "part string, version int"
STREAMS = "stream string, batch long"
NONE = "__HIVE_DEFAULT_PARTITION__"


class PartitionedTable:
    def __init__(self, spark: SparkSession, root: str, column: str):
        self.spark, self.root, self.column = spark, root.rstrip("/"), column
        self.folders = Folders(spark)

    def _commit(self, version: int) -> str:
        return f"{self.root}/commits/version={version}"

    def _data(self, version: int) -> str:
        return f"{self.root}/data/version={version}"

    def current(self) -> int:
        """The newest complete version; 0 before the first."""
        for number in reversed(self.folders.numbered(f"{self.root}/commits", "version=")):
            if self.folders.exists(f"{self._commit(number)}/parts/_SUCCESS"):
                return number
        return 0

    def _next(self) -> int:
        taken = [n for kind in ("commits", "data") for n in self.folders.numbered(f"{self.root}/{kind}", "version=")]
        return max(taken, default=0) + 1

    def parts(self, version: int | None = None) -> dict[str, int]:
        """Partition folder -> version that wrote it."""
        version = self.current() if version is None else version
        if not version:
            return {}
        return dict(map(tuple, self.spark.read.schema(PARTS).parquet(f"{self._commit(version)}/parts").collect()))

    def streams(self, version: int | None = None) -> dict[str, int]:
        """Stream -> number of its last batch in a version."""
        version = self.current() if version is None else version
        if not version:
            return {}
        return dict(map(tuple, self.spark.read.schema(STREAMS).parquet(f"{self._commit(version)}/streams").collect()))

    def folder(self, value) -> str:
        return f"{self.column}={NONE if value is None else value}"

    def replace(self, rows: DataFrame, values: Collection | None = None, batch: tuple[str, int] | None = None) -> int:
        """Put ``rows`` in place of the partitions of ``values`` (None: of the whole table); the new version's number.

        A value without rows loses its partition; rows of other values are refused. ``batch`` (stream and number)
        is committed with the version, so that a batch that comes again can be told.
        """
        number = self._next()
        rows.hint("rebalance", self.column).write.partitionBy(self.column).parquet(self._data(number))
        written = [f for f in self.folders.children(self._data(number)) if f.startswith(f"{self.column}=")]
        kept: dict[str, int] = {}
        if values is not None:
            replaced = {self.folder(v) for v in values}
            strange = set(written) - replaced
            if strange:
                raise ValueError(f"rows of partitions that are not to be replaced: {sorted(strange)}")
            kept = {part: v for part, v in self.parts().items() if part not in replaced}
        entries = [*kept.items(), *[(part, number) for part in written]]
        text = self.spark.createDataFrame([(rows.schema.json(),)], "value string")
        text.write.text(f"{self._commit(number)}/schema")
        streams = self.streams() | (dict([batch]) if batch else {})
        self.spark.createDataFrame(list(streams.items()), STREAMS).coalesce(1).write.parquet(f"{self._commit(number)}/streams")
        self.spark.createDataFrame(entries, PARTS).coalesce(1).write.parquet(f"{self._commit(number)}/parts")
        return number

    def read(self, version: int | None = None, values: Iterable | None = None) -> DataFrame | None:
        """The rows of a version, or those of some partitions; None before the first version."""
        version = self.current() if version is None else version
        if not version:
            return None
        schema = T.StructType.fromJson(json.loads(self.spark.read.text(f"{self._commit(version)}/schema").first().value))
        parts = self.parts(version)
        if values is not None:
            wanted = {self.folder(v) for v in values}
            parts = {part: v for part, v in parts.items() if part in wanted}
        if not parts:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self._data(v)}/{part}" for part, v in parts.items()]
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths)
        return rows.select(*[quoted(f.name) for f in schema.fields])

    def forget_before(self, version: int) -> list[str]:
        """Remove the commits before ``version`` and the folders that only they name; returns what went."""
        needed = set(self.parts(version).items())
        later = [n for n in self.folders.numbered(f"{self.root}/commits", "version=") if n > version]
        for n in later:
            if self.folders.exists(f"{self._commit(n)}/parts/_SUCCESS"):
                needed |= set(self.parts(n).items())
        gone = []
        for n in self.folders.numbered(f"{self.root}/data", "version="):
            for part in self.folders.children(self._data(n)) if n <= version else []:
                if (part, n) not in needed:
                    gone.append(f"{self._data(n)}/{part}")
        gone += [self._commit(n) for n in self.folders.numbered(f"{self.root}/commits", "version=") if n < version]
        for path in gone:
            self.folders.remove(path)
        return gone
