"""Monthly snapshots as periods in which nothing changed, and the period an event falls in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.operators.asof import snapshot_history


def _first_day(month: Column) -> Column:
    return F.make_date(F.floor(month / 100).cast("int"), month % 100, F.lit(1))


def validity_periods(snapshots: DataFrame, entity: str, year: str, month: str, fields: dict[str, str]) -> DataFrame:
    """One row per entity and period: entity, valid_from, valid_to, is_current and the fields.

    What holds in a month is what the as-of join gives for it: each field of the newest snapshot up to the
    month or, where it has none, of the next later one. Successive snapshots that say the same are one
    period. Periods of an entity follow each other without gap or overlap: the first one has no valid_from,
    the last one no valid_to, every other ends on the day before the next begins. The arrays this works on
    are bounded by the calendar, so one shuffle by entity is all it takes.
    """
    history = snapshot_history(snapshots, entity, year, month, fields)
    differs = lambda k: (k == 0) | ~F.get("records", k).eqNullSafe(F.get("records", k - 1))
    starts = F.filter(F.sequence(F.lit(0), F.size("months")), differs)
    begun = history.withColumn("starts", starts)
    periods = F.transform(
        "starts",
        lambda k, i: F.struct(
            _first_day(F.get("months", k - 1)).alias("valid_from"),
            F.date_sub(_first_day(F.get("months", F.get("starts", i + 1) - 1)), 1).alias("valid_to"),
            F.get("records", k).alias("record"),
        ),
    )
    listed = begun.select(entity, F.explode(periods).alias("p"))
    return listed.select(
        entity, "p.valid_from", "p.valid_to", F.col("p.valid_to").isNull().alias("is_current"), "p.record.*"
    )


def with_period(events: DataFrame, periods: DataFrame, entity: str, day: Column, key: str) -> DataFrame:
    """``events`` with the ``key`` of the period that ``day`` falls in; NULL for an entity without periods.

    An equi-join by entity with one row of few periods each, whatever the number of events: a frequent entity
    is split by the skew join of adaptive execution.
    """
    listed = periods.groupBy(F.col(entity).alias("__entity")).agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("valid_from", F.lit("0001-01-01").cast("date")).alias("since"), F.col(key)))).alias("__periods")
    )
    joined = events.join(listed, F.col(entity) == F.col("__entity"), "left")
    begun = F.filter("__periods", lambda p: p["since"] <= day)
    return joined.withColumn(key, F.try_element_at(begun, F.lit(-1))[key]).drop("__entity", "__periods")
