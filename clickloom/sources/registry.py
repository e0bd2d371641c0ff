"""Surrogate keys that never change: an append-only registry natural key -> number per dimension.

    <root>/version=N/    the keys that version N added: dim, parts, number

A key gets its number when it is first seen, above all numbers of its dimension, and keeps it. Numbers given by
a run that died later stay given, so nothing has to be undone; a folder that was not completed holds none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.operators.numbering import with_dense_key
from clickloom.session import materialize
from clickloom.sources.store import Folders

KEYS = "dim string, parts array<string>, number long"


class KeyRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.folders = Folders(spark)

    def _complete(self) -> list[int]:
        numbers = self.folders.numbered(self.root, "version=")
        return [n for n in numbers if self.folders.exists(f"{self.root}/version={n}/_SUCCESS")]

    def known(self) -> DataFrame:
        paths = [f"{self.root}/version={n}" for n in self._complete()]
        if not paths:
            return self.spark.createDataFrame([], KEYS)
        return self.spark.read.schema(KEYS).parquet(*paths)

    def register(self, found: DataFrame) -> DataFrame:
        """All keys with their numbers, those of ``found`` (dim, parts; distinct) that are new among them.

        Only unseen keys are sorted and numbered: in their order, each dimension above its highest number.
        """
        known = self.known()
        unseen = materialize(found.join(known, ["dim", "parts"], "left_anti"), "unseen-keys")
        if unseen.isEmpty():
            return known
        ordered = with_dense_key(unseen, ["dim", "parts"], "place")
        # One row per dimension.
        first = ordered.groupBy("dim").agg(F.min("place").alias("first"))
        highest = known.groupBy("dim").agg(F.max("number").alias("highest"))
        starts = first.join(highest, "dim", "left").select(
            "dim", (F.coalesce("highest", F.lit(0)) - F.col("first") + 1).alias("shift")
        )
        numbered = ordered.join(F.broadcast(starts), "dim").select("dim", "parts", (F.col("place") + F.col("shift")).alias("number"))
        taken = self.folders.numbered(self.root, "version=")
        numbered.write.parquet(f"{self.root}/version={max(taken, default=0) + 1}")
        return self.known()
