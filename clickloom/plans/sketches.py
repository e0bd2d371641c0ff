"""Distinct counts that add up: sketches of every day, united for reports over any range of days.

The log is read once, when a day is stored. A report over 7, 30 or 90 days unites the days' sketches and reads
nothing else; its counts of events are exact, its distinct counts are within a few percent (about 1.6 % standard
error with 2^12 registers).
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.functions import peppered_sha256
from clickloom.operators.flatten import property_bag, with_properties
from clickloom.sources.log import stored_days
from clickloom.sources.parts import PartitionedTable

DAY = "day"
REGISTERS = 12  # log2 of a sketch's registers
# What is counted per day, and the column it is counted in.
VISITS = {"users": "user_Id", "sessions": "session_Id", "gpns": "gpn", "hashes": "person_hash", "countries": "client_CountryOrRegion"}


def sketch_tables(spark: SparkSession, root: str) -> tuple[PartitionedTable, PartitionedTable]:
    """Sketches of visits per day, and of property values per day and key."""
    return PartitionedTable(spark, f"{root}/visits", DAY), PartitionedTable(spark, f"{root}/properties", DAY)


def _sketched(columns: Collection[str]) -> list[Column]:
    # A sketch passes over empty texts, which count as a value here.
    return [F.hll_sketch_agg(F.concat(F.lit("="), F.col(c)), REGISTERS).alias(c) for c in columns]


def visits_by_day(log: DataFrame, pepper: str) -> DataFrame:
    keep = ["user_Id", "session_Id", "client_CountryOrRegion", "timestamp"]
    rows = with_properties(log, {"gpn": "GPN"}, keep).withColumn("person_hash", peppered_sha256(F.col("gpn"), pepper))
    return rows.groupBy(F.to_date("timestamp").alias(DAY)).agg(
        F.count(F.lit(1)).alias("events"),
        F.min("timestamp").alias("first_event"),
        F.max("timestamp").alias("last_event"),
        *_sketched(VISITS.values()),
    )


def properties_by_day(log: DataFrame) -> DataFrame:
    """One row per day and key: events with it, the smallest value, and a sketch of its values."""
    pairs = log.select(F.to_date("timestamp").alias(DAY), F.explode(property_bag()).alias("key", "value"))
    return pairs.groupBy(DAY, "key").agg(
        F.count(F.lit(1)).alias("events"), F.min("value").alias("sample_value"), *_sketched(["value"])
    )


def update(tables: tuple[PartitionedTable, PartitionedTable], log: DataFrame, days: Collection[date | None] | None, pepper: str) -> None:
    """Store the sketches of some days (None: of all); ``log`` holds all rows of these days."""
    made = visits_by_day(log, pepper), properties_by_day(log)
    for table, rows in zip(tables, made):
        table.replace(rows, days)


def _days(table: PartitionedTable, since: date, until: date) -> list[date]:
    return [d for d in stored_days(table) if d is not None and since <= d <= until]


def _united(column: str) -> Column:
    return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(column)), F.lit(0))


def visits(table: PartitionedTable, since: date, until: date) -> DataFrame:
    """One row for the days from ``since`` to ``until``: events, distinct people in several senses, first and last time."""
    rows = table.read(values=_days(table, since, until))
    return rows.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"),
        *[_united(column).alias(name) for name, column in VISITS.items()],
        F.min("first_event").alias("first_event"),
        F.max("last_event").alias("last_event"),
    )


def property_values(table: PartitionedTable, since: date, until: date) -> DataFrame:
    """Per property key: events that carry it, distinct values, and the smallest value."""
    rows = table.read(values=_days(table, since, until))
    return rows.groupBy("key").agg(
        F.sum("events").alias("key_count"), _united("value").alias("distinct_values"), F.min("sample_value").alias("sample_value")
    )
