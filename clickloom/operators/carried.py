"""As-of join of events with snapshots taken at any time, by carrying the newest snapshot forward."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.operators.ordered import HotGroups, Ordered, add_ordered
from clickloom.schema import quoted

ENTITY, AT, KIND, NEWEST = "__entity", "__at", "__kind", "__newest"
# Order of rows at one instant: what holds before all snapshots, a snapshot, an event.
FIRST, SNAPSHOT, EVENT = 0, 1, 2
BEFORE_ALL = "0001-01-01 00:00:00"


def asof_time(
    events: DataFrame,
    snapshots: DataFrame,
    entity: str,
    event_time: Column,
    snapshot_time: Column,
    fields: dict[str, str],
    policy: HotGroups | None = HotGroups(),
) -> DataFrame:
    """Add each field as of the event: the newest snapshot up to it or, where that is NULL, the next later one.

    ``fields`` maps snapshot columns to result names (which replace columns of ``events``). For snapshots at the
    first of each month the result is that of ``asof_month``, but no array of an entity's snapshots is built, so
    they may be of any number. Events and snapshots are united, ordered per entity, and the newest snapshot is
    carried over the rows after it; an entity with a large part of all rows is spread over range slices, with one
    snapshot carried from slice to slice.

    An event before the first snapshot, or without a time, gets the first one; one without an entity, or whose
    entity has no snapshot, gets NULLs. Snapshots without entity or time are not used; of several of an entity at
    one time the greatest counts. Events are kept as they are, repeated ones too.
    """
    names = list(fields.values())
    known = (
        snapshots.select(
            quoted(entity).cast("string").alias(ENTITY),
            snapshot_time.cast("timestamp").alias(AT),
            F.struct(*[quoted(source).alias(name) for source, name in fields.items()]).alias("__told"),
        )
        .where(F.col(ENTITY).isNotNull() & F.col(AT).isNotNull())
        .groupBy(ENTITY, AT)
        .agg(F.max("__told").alias("__told"))
        .withColumn("__back", -F.unix_micros(AT))
    )
    followed = add_ordered(known, [ENTITY], ["__back"], Ordered(lags={"__next": "__told"}), policy)
    valid = F.struct(*[F.coalesce(F.col("__told")[n], F.col("__next")[n]).alias(n) for n in names])
    changes = followed.select(ENTITY, AT, F.lit(SNAPSHOT).alias(KIND), F.struct(AT, valid.alias("record")).alias(NEWEST))
    start = F.to_timestamp(F.lit(BEFORE_ALL))
    earliest = known.groupBy(ENTITY).agg(F.min_by("__told", AT).alias("__told"))
    before = earliest.select(
        ENTITY,
        start.alias(AT),
        F.lit(FIRST).alias(KIND),
        F.struct(start.alias(AT), F.col("__told").alias("record")).alias(NEWEST),
    )
    own = [c for c in events.columns if c not in names]
    rows = events.select(
        *[quoted(c) for c in own],
        quoted(entity).cast("string").alias(ENTITY),
        F.greatest(event_time.cast("timestamp"), start).alias(AT),
        F.lit(EVENT).alias(KIND),
    )
    together = rows.unionByName(changes.unionByName(before), allowMissingColumns=True)
    # The newest of the earlier snapshots is their maximum, since structs compare by time first.
    carried = add_ordered(together, [ENTITY], [AT, KIND], Ordered(max_before={"__valid": NEWEST}), policy)
    return carried.where(F.col(KIND) == EVENT).select(
        *[quoted(c) for c in own], *[F.col("__valid")["record"][n].alias(n) for n in names]
    )
