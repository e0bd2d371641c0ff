"""Data-profile reports over enriched events. Each is one pass over the columns it reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from clickloom.operators.shares import share_of_total, top
from clickloom.plans.enrich import BLANK_GPN
from clickloom.schema import quoted, resolve

BLANK = "(blank)"


def data_overview(events: DataFrame) -> DataFrame:
    return events.agg(
        F.min("session_date").alias("first_date"),
        F.max("session_date").alias("last_date"),
        F.count_distinct("session_date").alias("days"),
        F.count("*").alias("total_events"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("session_key").alias("unique_sessions"),
        F.count_distinct("gpn").alias("unique_gpns"),
    )


def hr_profile(hr: DataFrame) -> DataFrame:
    return hr.agg(
        F.count("*").alias("snapshot_rows"),
        F.count_distinct("gpn").alias("gpns"),
        F.count_distinct(F.struct("snapshot_year", "snapshot_month")).alias("snapshots"),
    )


def hr_coverage(events: DataFrame) -> DataFrame:
    counts = events.agg(
        F.count("*").alias("total"),
        F.count("hr_division").alias("with_hr_data"),
        F.count("gpn").alias("with_gpn"),
        F.count_if(F.col("gpn") == BLANK_GPN).alias("with_blank_gpn"),
    )
    whole = F.nullif(F.col("total"), F.lit(0)).cast("double")
    return counts.withColumns(
        {
            "gpn_pct": F.round(F.coalesce(100.0 * F.col("with_gpn") / whole, F.lit(0.0)), 1),
            "hr_pct": F.round(F.coalesce(100.0 * F.col("with_hr_data") / whole, F.lit(0.0)), 1),
        }
    )


def top_divisions(events: DataFrame, k: int = 10) -> DataFrame:
    known = events.where(F.col("hr_division").isNotNull())
    return top(
        known.groupBy("hr_division").agg(F.count("*").alias("cnt")), "cnt", ["hr_division"], k
    )


def unmatched_people(events: DataFrame, k: int = 15) -> DataFrame:
    unmatched = events.where(F.col("gpn").isNotNull() & F.col("hr_division").isNull())
    return top(unmatched.groupBy("gpn").agg(F.count("*").alias("cnt")), "cnt", ["gpn"], k)


def checked_fields(columns: Sequence[str], property_limit: int | None = None) -> list[str]:
    base = [c for c in ("gpn", "email", "session_id", "user_id") if c in columns]
    organisation = [c for c in columns if c.startswith("hr_")]
    properties = [c for c in columns if c.startswith("CP_")]
    return base + organisation + properties[:property_limit]


def field_coverage(events: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Non-null count and percent per field, all counted in one aggregation."""
    names = list(fields or checked_fields(events.columns))
    counts = events.agg(
        F.count("*").alias("__total"), *[F.count(quoted(c)).alias(c) for c in names]
    )
    long = counts.unpivot("__total", names, "field", "filled")
    percent = F.coalesce(100.0 * F.col("filled") / F.nullif("__total", F.lit(0)), F.lit(0.0))
    return long.select(
        "field", "filled", F.col("__total").alias("total"), F.round(percent, 1).alias("pct")
    )


def share_by(events: DataFrame, field: str, name: str, k: int | None = None) -> DataFrame:
    """Count and percent per value of a logical field, NULL shown as ``(blank)``."""
    column = field if field in events.columns else resolve(events.columns, field)
    return share_of_total(events, F.coalesce(quoted(column), F.lit(BLANK)), name, 1, k)


def event_types(events: DataFrame) -> DataFrame:
    return share_of_total(events, F.col("name"), "name")


def precision_check(events: DataFrame, column: str = "timestamp") -> DataFrame:
    """How many times carry a fraction of a second; none means the export cut them."""
    fraction = F.unix_micros(column) % 1_000_000
    return events.agg(
        F.count("*").alias("total"), F.count_if(fraction != 0).alias("with_fraction")
    ).withColumn("has_fraction", F.col("with_fraction") > 0)


def gpn_sample(events: DataFrame, k: int = 5) -> DataFrame:
    """A few person numbers, to compare the spelling on both sides of the organisation join."""
    filled = events.where(F.trim("gpn") != "")
    return filled.select("gpn").distinct().orderBy("gpn").limit(k)


def summary(events: DataFrame) -> dict[str, DataFrame]:
    """All reports the columns of ``events`` allow."""
    reports = {
        "data_overview": data_overview(events),
        "field_coverage": field_coverage(events),
        "event_types": event_types(events),
        "precision": precision_check(events),
    }
    if "hr_division" in events.columns:
        reports |= {
            "hr_coverage": hr_coverage(events),
            "top_divisions": top_divisions(events),
            "unmatched_people": unmatched_people(events),
        }
    for field, name, k in (
        ("link_type", "link_type", None),
        ("component", "component", 10),
        ("site_name", "site_name", 10),
    ):
        if resolve(events.columns, field):
            reports[f"share_by_{name}"] = share_by(events, field, name, k)
    return reports
