"""Raw log rows as they arrive, into the log by day and the event store.

Every micro-batch is a delivery: its rows are added to their days, and the days it reached are flattened and
merged by key, as a batch run would do it. A batch that comes again after a killed run is in the log at most
once, because its number is committed with the rows; and events are merged from the days of the log whose
version the store does not know, so a run that died before merging is made up for by the next batch, or the
next run without one. Files that change in place stay with the batch ingest: a file stream sees names only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from clickloom.plans.ingest import ingest_log
from clickloom.sources.log import store_log
from clickloom.sources.parts import PartitionedTable
from clickloom.sources.store import EventStore


def log_files(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """The Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def stream_log(source: DataFrame, log: PartitionedTable, store: EventStore, checkpoint: str, name: str = "log") -> None:
    """Take in everything that ``source`` has to give now, and return; the next call goes on from there."""
    def merge(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            store_log(log, batch, batch=(name, number))
        ingest_log(store, log)

    query = (
        source.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .foreachBatch(merge)
        .start()
    )
    query.awaitTermination()
    ingest_log(store, log)
