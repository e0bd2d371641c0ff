"""Derived event columns: person number, local time, session key, organisation fields, gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions import gap_bucket, millis_between, normalize_gpn, or_empty, utc_to_local
from clickloom.functions.times import iso_weekday, millis_text
from clickloom.operators.asof import asof_month, month_number, snapshot_history
from clickloom.operators.ordered import HotGroups, Ordered, add_ordered
from clickloom.schema import HR_FIELDS, quoted, spellings_in

BLANK_GPN = "00000000"


def person_columns(raw: DataFrame, blank_gpn_is_null: bool = False) -> dict[str, Column]:
    numbers = spellings_in(raw.columns, "gpn")
    addresses = spellings_in(raw.columns, "email")
    missing = F.lit(None).cast("string")
    gpn = normalize_gpn(*map(quoted, numbers)) if numbers else missing
    if blank_gpn_is_null:
        gpn = F.nullif(gpn, F.lit(BLANK_GPN))
    email = F.coalesce(*[quoted(c).cast("string") for c in addresses]) if addresses else missing
    return {"gpn": gpn, "email": email}


def with_session_columns(raw: DataFrame, blank_gpn_is_null: bool = False) -> DataFrame:
    """Person, local-time and session columns; none of them needs a shuffle."""
    local = F.col("timestamp_cet")
    return (
        raw.withColumns(
            person_columns(raw, blank_gpn_is_null)
            | {
                "timestamp_str": millis_text(F.col("timestamp")),
                "timestamp_cet": utc_to_local(F.col("timestamp")),
            }
        )
        .withColumns(
            {"timestamp_cet_str": millis_text(local), "session_date": F.to_date(local)}
        )
        .withColumns(
            {
                "session_key": F.concat_ws(
                    "_",
                    or_empty(F.col("session_date")),
                    or_empty(F.col("user_id")),
                    or_empty(F.col("session_id")),
                ),
                "event_hour": F.hour(local),
                "event_weekday": F.date_format(local, "EEEE"),
                "event_weekday_num": iso_weekday(local),
            }
        )
    )


def with_organisation(events: DataFrame, hr: DataFrame, pad_gpn: bool = False) -> DataFrame:
    """Organisation fields as of the event's UTC month; only fields the snapshots carry are added."""
    fields = {source: alias for source, alias in HR_FIELDS.items() if source in hr.columns}
    if not fields:
        return events
    snapshots = hr.withColumn("gpn", normalize_gpn(F.col("gpn"))) if pad_gpn else hr
    history = snapshot_history(snapshots, "gpn", "snapshot_year", "snapshot_month", fields)
    event_month = month_number(F.year("timestamp"), F.month("timestamp"))
    return asof_month(events, history, "gpn", event_month, list(fields.values()))


def with_event_order(
    events: DataFrame,
    ties: Sequence[str] = ("name",),
    hot: HotGroups | None = HotGroups(),
) -> DataFrame:
    """Position in the session and the gap to the event before.

    The default tie-break completes the event key (time, user, session, name) inside a session.
    """
    ordered = add_ordered(
        events,
        ["session_key"],
        ["timestamp", *ties],
        Ordered(
            lags={"prev_event": "name", "prev_timestamp": "timestamp"}, position="event_order"
        ),
        hot,
    )
    gap = millis_between(F.col("prev_timestamp"), F.col("timestamp"))
    gapped = ordered.withColumn("ms_since_prev_event", gap)
    ms = F.col("ms_since_prev_event")
    return gapped.withColumns(
        {
            "sec_since_prev_event": F.round(ms / F.lit(1000.0), 3),
            "time_since_prev_bucket": gap_bucket(F.col("prev_timestamp"), ms),
        }
    )


def enrich(
    raw: DataFrame,
    hr: DataFrame | None = None,
    *,
    ties: Sequence[str] = ("name",),
    blank_gpn_is_null: bool = False,
    pad_hr_gpn: bool = False,
    hot: HotGroups | None = HotGroups(),
) -> DataFrame:
    """All derived columns. Without person numbers or snapshots no organisation fields are added.

    Ordering comes before the organisation join, so that the size check of sessions reads three columns
    of the raw table and nothing is shuffled after a join that may have been split for skew.
    """
    events = with_event_order(with_session_columns(raw, blank_gpn_is_null), ties, hot)
    if hr is not None and spellings_in(raw.columns, "gpn"):
        events = with_organisation(events, hr, pad_hr_gpn)
    return events


def local_time_sample(events: DataFrame, k: int = 3) -> DataFrame:
    """The first events with their UTC and local hours, to check the conversion by eye."""
    return (
        events.orderBy("timestamp", "session_key")
        .limit(k)
        .select(
            F.col("timestamp").alias("utc_timestamp"),
            F.col("timestamp_cet").alias("cet_timestamp"),
            F.hour("timestamp").alias("utc_hour"),
            F.col("event_hour").alias("cet_hour"),
            "session_date",
        )
    )
