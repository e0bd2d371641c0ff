"""The raw log as a table of UTC days."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.operators.flatten import CLICK_EVENT, recent
from clickloom.sources.parts import PartitionedTable

DAY = "log_day"


def log_table(spark: SparkSession, root: str) -> PartitionedTable:
    return PartitionedTable(spark, root, DAY)


def store_log(table: PartitionedTable, rows: DataFrame, replace: bool = False, batch: tuple[str, int] | None = None) -> int:
    """Add log rows to their days, or with ``replace`` put them in place of these days; other days stay untouched.

    A ``batch`` of a stream that the table has already is not added again.
    """
    if batch and table.streams().get(batch[0], -1) >= batch[1]:
        return table.current()
    dated = rows.withColumn(DAY, F.to_date("timestamp"))
    days = [r[DAY] for r in dated.select(DAY).distinct().collect()]  # at most the calendar
    before = None if replace else table.read(values=days)
    if before is not None:
        dated = before.unionByName(dated, allowMissingColumns=True)
    return table.replace(dated, days, batch)


def stored_days(table: PartitionedTable) -> dict[date | None, int]:
    """The days of the log and the version that wrote each."""
    names = {part.removeprefix(f"{table.column}="): v for part, v in table.parts().items()}
    return {None if n.startswith("__") else date.fromisoformat(n): v for n, v in names.items()}


def recent_log(table: PartitionedTable, as_of: datetime, days: int, name: str | None = CLICK_EVENT) -> DataFrame | None:
    """Log rows of the ``days`` before ``as_of``; only the folders of these days are listed and opened."""
    since = (as_of - timedelta(days=days)).date()
    wanted = [d for d in stored_days(table) if d is not None and d >= since]
    rows = table.read(values=wanted)
    return None if rows is None else recent(rows, as_of, days, name).drop(DAY)
