"""Derived tables that follow deliveries: viewing sessions and facts of the dates that changed."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.operators.ordered import HotGroups
from clickloom.plans import star, video
from clickloom.session import materialize
from clickloom.sources.parts import PartitionedTable
from clickloom.sources.registry import KeyRegistry

SESSIONS_BY, FACTS_BY = "first_date", "session_date"


def session_table(spark: SparkSession, output: str) -> PartitionedTable:
    return PartitionedTable(spark, f"{output}/video_sessions", SESSIONS_BY)


def fact_table(spark: SparkSession, output: str) -> PartitionedTable:
    return PartitionedTable(spark, f"{output}/cdm/fact_event", FACTS_BY)


def key_registry(spark: SparkSession, output: str) -> KeyRegistry:
    return KeyRegistry(spark, f"{output}/cdm/keys")


def on_dates(events: DataFrame, dates: Collection[date | None]) -> DataFrame:
    """Events of some local dates; None stands for those without a time."""
    known = [d for d in dates if d is not None]
    wanted = F.col("session_date").isin(known) if known else F.lit(False)
    return events.where(wanted | F.col("session_date").isNull() if None in dates else wanted)


def update_sessions(
    table: PartitionedTable,
    events: DataFrame,
    changed: Collection[date | None] | None,
    rules: Mapping[str, object] | None = None,
    hot: HotGroups | None = HotGroups(),
) -> DataFrame:
    """Bring the session table up to date with ``events``, of which only ``changed`` local dates differ; returns it.

    A session is affected when it has an event on a changed date now, or had one on record. Affected sessions
    are made anew from the events of the dates they span, all others stay as recorded. So events are read for
    changed dates and for those that affected sessions reach back to (a session without id is one per viewer
    and video, and may reach far), and only the partitions that affected sessions begin in are written.
    ``changed=None`` makes all sessions anew.
    """
    rules = dict(rules or {})
    recorded = table.read()
    if changed is None or recorded is None:
        table.replace(video.session_states(events, hot=hot, **rules))
        return table.read()
    dates = sorted(d for d in changed if d is not None)  # video events have a time
    if not dates:
        return recorded
    keys = video.VIEWING
    delivered = materialize(video.video_events(on_dates(events, dates)).select(*keys).distinct(), "delivered-sessions")
    spans = recorded.select(*keys, "first_date", "last_date")
    met = F.exists(F.lit(dates), lambda d: (F.col("first_date") <= d) & (d <= F.col("last_date")))
    continued = video.join_sessions(spans, delivered, "left_semi")
    before = materialize(spans.where(met).union(continued).distinct(), "recorded-sessions")
    affected = materialize(delivered.union(before.select(*keys)).distinct(), "affected-sessions")
    reach = before.select(F.explode(F.sequence("first_date", "last_date")).alias("d")).distinct().collect()
    needed = {r.d for r in reach} | set(dates)  # at most the calendar

    source = on_dates(events, needed)
    clip = video.video_key(source.columns)
    mine = affected.withColumnsRenamed({k: f"__a_{k}" for k in keys})
    same = (F.col("gpn") == F.col("__a_gpn")) & (clip == F.col("__a_video_id"))
    history = source.join(mine, same & F.col("session_id").eqNullSafe(F.col("__a_session_id")), "left_semi")
    fresh = materialize(video.session_states(history, hot=hot, **rules), "fresh-sessions")
    begun = before.select("first_date").union(fresh.select("first_date")).distinct().collect()
    parts = {r.first_date for r in begun}  # at most the calendar
    if not parts:
        return recorded
    beside = table.read(values=parts)
    kept = video.join_sessions(beside, affected, "left_anti")
    table.replace(kept.unionByName(fresh), parts)
    return table.read()


def update_facts(
    table: PartitionedTable,
    registry: KeyRegistry,
    events: DataFrame,
    changed: Collection[date | None] | None,
    pepper: str,
    history: DataFrame | None = None,
) -> star.Star:
    """Bring facts and keys up to date; returns the dimensions. With a ``history`` facts carry its version keys.

    Natural keys of the changed dates that are new get their numbers, all others keep theirs, so facts of
    other dates stay as they are. ``changed=None`` makes all facts anew, with the same numbers as before.
    """
    source = events if changed is None else on_dates(events, changed)
    known = star.dimensions(source, registry)
    dims = star.Star(**{name: materialize(dim, name) for name, dim in vars(known).items()})
    if changed is None or changed:
        keep = ["session_date"]
        if history is not None and "gpn" in source.columns:
            source, keep = star.with_org_version(source, history), [*keep, "org_version_key"]
        facts = star.fact_event(source, dims, pepper, keep)
        table.replace(facts, None if changed is None or not table.current() else changed)
    return dims
