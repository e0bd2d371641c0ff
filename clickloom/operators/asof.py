"""As-of join of events with monthly snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MONTH = "__ym"


def month_number(year: Column, month: Column) -> Column:
    return (year * 100 + month).cast("int")


def snapshot_history(
    snapshots: DataFrame, entity: str, year: str, month: str, fields: dict[str, str]
) -> DataFrame:
    """One row per entity: the months of its snapshots in order, and what holds between them.

    ``months`` has n entries and ``records`` n + 1: record k is valid for events with k snapshots up to
    their month. It takes each field from snapshot k or, where that is NULL or there is none, from the
    next later one. ``fields`` maps snapshot columns to result names.

    Snapshots of one entity and month are first reduced to one (the greatest, so the choice does not
    depend on row order). That bounds the arrays by the number of calendar months, however many rows an
    entity has.
    """
    monthly = (
        snapshots.where(F.col(entity).isNotNull())
        .groupBy(
            F.col(entity).cast("string").alias(entity),
            month_number(F.col(year), F.col(month)).alias(MONTH),
        )
        .agg(F.max(F.struct(*fields)).alias("snapshot"))
        .where(F.col(MONTH).isNotNull())
    )
    ordered = monthly.groupBy(entity).agg(
        F.array_sort(F.collect_list(F.struct(MONTH, "snapshot"))).alias("history")
    )

    def valid_after(k: Column) -> Column:
        matched, later = F.get("history", k - 1), F.get("history", k)
        return F.struct(
            *[
                F.coalesce(matched["snapshot"][source], later["snapshot"][source]).alias(alias)
                for source, alias in fields.items()
            ]
        )

    return ordered.select(
        entity,
        F.transform("history", lambda s: s[MONTH]).alias("months"),
        F.transform(F.sequence(F.lit(0), F.size("history")), valid_after).alias("records"),
    )


def asof_month(
    events: DataFrame, history: DataFrame, entity: str, event_month: Column, fields: list[str]
) -> DataFrame:
    """Add each field as of the event's month: the newest snapshot up to it, else the oldest later one.

    One equi-join on the entity, whose right side is unique; an event only counts months and picks a
    record. A hot entity is split by the skew join of adaptive execution, and the measured size of the
    histories decides between broadcast and sort-merge.
    """
    right = history.select(F.col(entity).alias("__entity"), "months", "records")
    joined = events.withColumn(MONTH, event_month).join(
        right, F.col(entity) == F.col("__entity"), "left"
    )
    passed = F.size(F.filter("months", lambda m: m <= F.col(MONTH)))
    found = joined.withColumn("__record", F.get("records", passed))
    return found.withColumns({f: F.col("__record")[f] for f in fields}).drop(
        "__entity", "months", "records", "__record", MONTH
    )
