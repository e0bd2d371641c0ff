"""Video engagement: play segments, merged watch time, sessions, views, per-viewer metrics."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Literal

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions import or_empty
from clickloom.functions.text import is_filled, settled
from clickloom.functions.times import seconds_between, utc_to_local
from clickloom.operators.ordered import HotGroups, Ordered, add_ordered
from clickloom.schema import optional, resolve
from clickloom.session import materialize

VIEWING = ["gpn", "video_id", "session_id"]
VIEWER = ["gpn", "video_id"]

# Rules of a valid watch segment, skips, score and flags.
ACTIONS = ("play", "pause", "resume", "ended")
STARTS = ("play", "resume")
STOPS = ("pause", "ended")
MAX_SEGMENT_SECONDS = 7200
CLOCK_TOLERANCE_SECONDS = 5
FORWARD_JUMP_SECONDS = 5
BACKWARD_JUMP_SECONDS = -2
TIERS = ((100, "High"), (50, "Medium"), (10, "Low"))
LOWEST_TIER = "Minimal"
EXCESSIVE_FACTOR = 1.2
UNKNOWN_DURATION = 999999
SHORT_WATCH_SECONDS = 5
SUFFICIENT_PERCENT = 75


def has_video(events: DataFrame) -> bool:
    return all(resolve(events.columns, field) for field in ("video_action", "video_id"))


def video_key(columns: list[str]) -> Column:
    return F.trim(optional(columns, "video_id"))


def video_events(events: DataFrame) -> DataFrame:
    """Normalized play, pause, resume and ended events of known people and videos."""
    if not has_video(events):
        raise ValueError("no video action and video id columns")

    def of(field: str, data_type: str = "string") -> Column:
        return optional(events.columns, field, data_type)

    return events.select(
        "timestamp",
        "gpn",
        "session_id",
        F.lower(F.trim(of("video_action"))).alias("action"),
        video_key(events.columns).alias("video_id"),
        of("video_title").alias("video_title"),
        of("video_duration", "double").alias("video_duration"),
        of("video_position", "double").alias("current_time_pos"),
        of("video_type").alias("video_type"),
        of("video_address").alias("video_address"),
    ).where(
        F.col("action").isin(*ACTIONS)
        & is_filled(F.col("video_id"))
        & is_filled(F.col("gpn"))
        & F.col("timestamp").isNotNull()
    )


def segments(
    video: DataFrame,
    *,
    count_first_event: bool = False,
    valid_is_no_skip: bool = False,
    hot: HotGroups | None = HotGroups(),
) -> DataFrame:
    """Each event with its predecessor in the viewing session, and whether the two enclose watching.

    Events without predecessor are left out unless ``count_first_event``. Every forward move of more than
    five seconds counts as a skip unless ``valid_is_no_skip`` exempts valid segments.
    """
    lagged = add_ordered(
        video,
        VIEWING,
        ["timestamp", "action", "current_time_pos"],
        Ordered(
            lags={
                "prev_action": "action",
                "prev_time_pos": "current_time_pos",
                "prev_timestamp": "timestamp",
            }
        ),
        hot,
    )
    if not count_first_event:
        lagged = lagged.where(F.col("prev_action").isNotNull())
    moved = F.col("time_delta")
    valid = (
        F.col("prev_action").isin(*STARTS)
        & F.col("action").isin(*STOPS)
        & (moved > 0)
        & (moved < MAX_SEGMENT_SECONDS)
        & (moved <= F.col("timestamp_delta") + CLOCK_TOLERANCE_SECONDS)
    )
    jump = (
        F.when(moved > FORWARD_JUMP_SECONDS, "forward")
        .when(moved < BACKWARD_JUMP_SECONDS, "backward")
        .otherwise("none")
    )
    if valid_is_no_skip:
        jump = F.when(F.col("is_valid_segment"), "none").otherwise(jump)
    return (
        lagged.withColumns(
            {
                "time_delta": F.col("current_time_pos") - F.col("prev_time_pos"),
                "timestamp_delta": seconds_between(F.col("prev_timestamp"), F.col("timestamp")),
            }
        )
        .withColumn("is_valid_segment", valid)
        .withColumns(
            {
                "watched_seconds": F.when(F.col("is_valid_segment"), moved).otherwise(0.0),
                "jump_type": jump,
            }
        )
    )


def unique_seconds(
    segs: DataFrame,
    mode: Literal["lag", "running_max"] = "lag",
    hot: HotGroups | None = HotGroups(),
) -> DataFrame:
    """Seconds of video seen at least once per viewing session.

    ``lag`` opens a new interval when a segment starts after the end of the one before it, so a short
    segment inside a long one splits the long one's coverage. ``running_max`` compares with the furthest
    end so far and measures the true union.
    """
    valid = segs.where(F.col("is_valid_segment")).select(
        *VIEWING,
        F.col("prev_time_pos").alias("segment_start"),
        F.col("current_time_pos").alias("segment_end"),
    )
    order = ["segment_start", "segment_end"]
    start, end = F.col("segment_start"), F.col("segment_end")
    if mode == "running_max":
        reached = add_ordered(
            valid, VIEWING, order, Ordered(max_before={"reached": "segment_end"}), hot
        )
        fresh = F.greatest(end - F.greatest(start, F.col("reached")), F.lit(0.0))
        return reached.groupBy(*VIEWING).agg(F.sum(fresh).alias("unique_seconds_watched"))

    def opens_interval(df: DataFrame) -> DataFrame:
        after_gap = F.col("prev_end").isNull() | (start > F.col("prev_end"))
        return df.withColumn("opens", F.when(after_gap, 1).otherwise(0))

    grouped = add_ordered(
        valid,
        VIEWING,
        order,
        Ordered(
            lags={"prev_end": "segment_end"},
            derive=opens_interval,
            running_sum={"interval_id": "opens"},
        ),
        hot,
    )
    intervals = grouped.groupBy(*VIEWING, "interval_id").agg(
        (F.max("segment_end") - F.min("segment_start")).alias("seconds")
    )
    return intervals.groupBy(*VIEWING).agg(F.sum("seconds").alias("unique_seconds_watched"))


def sessions(segs: DataFrame, unique: DataFrame) -> DataFrame:
    """One row per viewing session. Sessions without id find no merged seconds (NULL never joins)."""
    per_session = segs.groupBy(*VIEWING).agg(
        F.coalesce(F.sum("watched_seconds"), F.lit(0.0)).alias("watch_time"),
        F.max("current_time_pos").alias("max_position"),
        F.min("timestamp").alias("session_start"),
        F.max("timestamp").alias("session_end"),
        F.max(F.when(F.col("action") == "ended", 1).otherwise(0)).alias("completed"),
        F.count_if(F.col("action") == "pause").alias("pause_count"),
        F.count_if(F.col("jump_type") == "forward").alias("forward_skip_count"),
        F.count_if(F.col("jump_type") == "backward").alias("backward_skip_count"),
        F.count("*").alias("event_count"),
    )
    return per_session.join(unique, VIEWING, "left").withColumn(
        "unique_seconds_watched", F.coalesce("unique_seconds_watched", F.lit(0.0))
    )


def views(segs: DataFrame) -> DataFrame:
    """Views per viewer and video: the plays of each UTC day, or one for a day with only a valid resume."""
    return views_of_days(days(segs, VIEWER))


def days(segs: DataFrame, keys: list[str]) -> DataFrame:
    """Plays and valid resumes of each UTC day."""
    resumed = F.col("is_valid_segment") & (F.col("prev_action") == "resume")
    return segs.groupBy(*keys, F.to_date("timestamp").alias("watch_day")).agg(
        F.count_if(F.col("action") == "play").alias("play_count"),
        F.count_if(resumed).alias("resume_count"),
    )


def views_of_days(daily: DataFrame) -> DataFrame:
    day_views = F.when(F.col("play_count") > 0, F.col("play_count")).otherwise(
        F.when(F.col("resume_count") > 0, 1).otherwise(0)
    )
    return daily.groupBy(*VIEWER).agg(F.sum(day_views).alias("total_views"))


def viewer_video(sess: DataFrame, view_counts: DataFrame) -> DataFrame:
    """One row per viewer and video. Sessions are unique here, so counting them needs no distinct."""
    totals = sess.groupBy(*VIEWER).agg(
        F.sum("watch_time").alias("total_watch_time"),
        F.sum("unique_seconds_watched").alias("unique_seconds_watched"),
        F.max("max_position").alias("max_position_reached"),
        F.count("session_id").alias("session_count"),
        F.sum("completed").alias("completion_count"),
        settled(F.avg("pause_count"), 2).alias("avg_pauses_per_session"),
        F.sum("forward_skip_count").alias("total_forward_skips"),
        F.sum("backward_skip_count").alias("total_backward_skips"),
        F.min("session_start").alias("first_watch"),
        F.max("session_end").alias("last_watch"),
        settled(F.avg("watch_time"), 2).alias("avg_watch_time_per_session"),
    )
    return totals.join(view_counts, VIEWER, "left").withColumn(
        "total_views", F.coalesce("total_views", F.lit(0))
    )


def metadata(video: DataFrame) -> DataFrame:
    """Longest reported duration, and title, type and address of the latest event (even when NULL)."""
    # Numbers first, which needs no sort; only the rows of each video's last moment are compared as a whole.
    last = video.groupBy(F.col("video_id").alias("last_id")).agg(
        F.max("video_duration").alias("reported_duration"), F.max("timestamp").alias("last_time")
    )
    described = F.struct("video_title", "video_type", "video_address")
    same = F.col("video_id").eqNullSafe(F.col("last_id")) & F.col("timestamp").eqNullSafe(F.col("last_time"))
    latest = (
        video.join(last, same).groupBy("video_id", "reported_duration").agg(F.max(described).alias("latest"))
    )
    return latest.select(
        "video_id",
        "reported_duration",
        F.col("latest.video_title").alias("latest_title"),
        F.col("latest.video_type").alias("latest_type"),
        F.col("latest.video_address").alias("latest_address"),
    )


def engagement(per_viewer: DataFrame, described: DataFrame) -> DataFrame:
    """Percentages, score, tier and quality flag per viewer and video."""
    watched, seen = F.col("total_watch_time"), F.col("unique_seconds_watched")
    reached, completions = F.col("max_position_reached"), F.col("completion_count")
    skips = F.col("total_forward_skips") + F.col("total_backward_skips")
    duration = F.col("video_duration")

    def percent(part: Column) -> Column:
        return F.when(duration > 0, part / duration * 100)

    score = watched / 60.0 + completions * 50.0 + F.col("session_count") * 5.0 - skips * 2.0
    tier = F.lit(None)
    for bound, name in reversed(TIERS):
        tier = F.when(F.col("score") > bound, name).otherwise(tier)
    flag = (
        F.when(
            watched > F.coalesce(duration, F.lit(float(UNKNOWN_DURATION))) * EXCESSIVE_FACTOR,
            "excessive_watch_time",
        )
        .when(watched < SHORT_WATCH_SECONDS, "very_short_watch")
        .when(
            (completions > 0) & (percent(watched) < SUFFICIENT_PERCENT),
            "completed_without_sufficient_watch",
        )
        .otherwise("ok")
    )
    joined = per_viewer.join(described, "video_id", "left").withColumn(
        "video_duration", F.coalesce("reported_duration", "max_position_reached")
    )
    return joined.withColumn("score", score).select(
        "gpn",
        "video_id",
        or_empty(F.col("latest_title")).alias("video_title"),
        or_empty(F.col("latest_type")).alias("video_type"),
        or_empty(F.col("latest_address")).alias("video_address"),
        "video_duration",
        settled(watched, 2).alias("total_watch_time"),
        settled(seen, 2).alias("unique_seconds_watched"),
        settled(reached, 2).alias("max_position_reached"),
        settled(percent(watched), 2).alias("watch_percentage"),
        settled(percent(reached), 2).alias("completion_percentage"),
        settled(percent(seen), 2).alias("unique_watch_percentage"),
        "session_count",
        completions.cast("int").alias("completion_count"),
        F.col("total_views").cast("int").alias("total_views"),
        (completions > 0).alias("is_completed"),
        (F.col("session_count") > 1).alias("is_replay"),
        "avg_pauses_per_session",
        F.col("total_forward_skips").cast("int").alias("total_forward_skips"),
        F.col("total_backward_skips").cast("int").alias("total_backward_skips"),
        settled(F.col("score"), 2).alias("engagement_score"),
        F.coalesce(tier, F.lit(LOWEST_TIER)).alias("engagement_tier"),
        flag.alias("data_quality_flag"),
        F.to_date("first_watch").alias("first_watch_date"),
        F.to_date("last_watch").alias("last_watch_date"),
        "avg_watch_time_per_session",
    )


def video_engagement(
    events: DataFrame,
    *,
    mode: Literal["lag", "running_max"] = "lag",
    count_first_event: bool = False,
    valid_is_no_skip: bool = False,
    hot: HotGroups | None = HotGroups(),
) -> DataFrame:
    """The whole chain from enriched events to one row per viewer and video.

    Segments feed three aggregations, so they are written once and read with only the columns each needs.
    """
    video = video_events(events)
    segs = materialize(
        segments(
            video,
            count_first_event=count_first_event,
            valid_is_no_skip=valid_is_no_skip,
            hot=hot,
        ).drop("video_title", "video_duration", "video_type", "video_address"),
        "video-segments",
    )
    per_viewer = viewer_video(sessions(segs, unique_seconds(segs, mode, hot)), views(segs))
    return engagement(per_viewer, metadata(video))


def join_sessions(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join by viewing session; a missing session id is a key, too."""
    right = right.withColumnsRenamed({k: f"__r_{k}" for k in VIEWING})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in VIEWING])
    return left.join(right, same, how).drop(*[f"__r_{k}" for k in VIEWING])


def session_states(
    events: DataFrame,
    *,
    mode: Literal["lag", "running_max"] = "lag",
    count_first_event: bool = False,
    valid_is_no_skip: bool = False,
    hot: HotGroups | None = HotGroups(),
) -> DataFrame:
    """Everything that engagement needs of each viewing session, so that events are not read again.

    Sessions without a counted event are there too, with NULL metrics: an event that comes later may count.
    ``first_date`` and ``last_date`` are the local dates that the session's events span.
    """
    video = materialize(video_events(events), "video-events")
    segs = materialize(
        segments(video, count_first_event=count_first_event, valid_is_no_skip=valid_is_no_skip, hot=hot).drop(
            "video_title", "video_duration", "video_type", "video_address"
        ),
        "video-segments",
    )
    local = F.to_date(utc_to_local(F.col("timestamp")))
    spans = video.groupBy(*VIEWING).agg(
        F.min(local).alias("first_date"),
        F.max(local).alias("last_date"),
        F.max("video_duration").alias("video_duration"),
        F.max(F.struct("timestamp", "video_title", "video_type", "video_address")).alias("latest"),
    )
    counted = sessions(segs, unique_seconds(segs, mode, hot))
    daily = days(segs, VIEWING).groupBy(*VIEWING).agg(
        F.array_sort(F.collect_list(F.struct("watch_day", "play_count", "resume_count"))).alias("days")
    )
    return join_sessions(join_sessions(spans, counted, "left"), daily, "left")


def engagement_of_sessions(states: DataFrame) -> DataFrame:
    """What ``video_engagement`` gives for the events that the session states were made from."""
    counted = states.where(F.col("event_count").isNotNull())
    listed = counted.select(*VIEWER, F.explode("days").alias("d")).select(*VIEWER, "d.*")
    daily = listed.groupBy(*VIEWER, "watch_day").agg(
        F.sum("play_count").alias("play_count"), F.sum("resume_count").alias("resume_count")
    )
    # The latest event of a video is the latest of its sessions' latest ones.
    described = metadata(states.select("video_id", "video_duration", "latest.*"))
    return engagement(viewer_video(counted, views_of_days(daily)), described)


def engagement_summary(engaged: DataFrame) -> DataFrame:
    completed = F.col("is_completed")
    return engaged.agg(
        F.count("*").alias("combinations"),
        F.count_distinct("gpn").alias("unique_viewers"),
        F.count_distinct("video_id").alias("unique_videos"),
        settled(F.avg("total_watch_time"), 1).alias("avg_watch_time"),
        settled(F.avg(F.when(completed, F.col("watch_percentage"))), 1).alias(
            "avg_completion_watch_pct"
        ),
        F.count_if(completed).alias("completed_count"),
        F.count_if(F.col("data_quality_flag") == "completed_without_sufficient_watch").alias(
            "gaming_count"
        ),
        F.count_if(F.col("data_quality_flag") != "ok").alias("flagged"),
    )


def tier_distribution(engaged: DataFrame) -> DataFrame:
    names = [name for _, name in TIERS] + [LOWEST_TIER]
    rank = F.array_position(F.lit(names), F.col("engagement_tier"))
    counts = engaged.groupBy("engagement_tier").agg(F.count("*").alias("n"))
    return counts.orderBy(rank)


def action_distribution(video: DataFrame) -> DataFrame:
    return video.groupBy("action").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "action")


def segment_totals(segs: DataFrame) -> DataFrame:
    valid = F.col("is_valid_segment")
    return segs.agg(
        F.count_if(valid).alias("valid_segments"),
        F.coalesce(F.sum(F.when(valid, F.col("watched_seconds"))), F.lit(0.0)).alias(
            "total_watch_seconds"
        ),
    )
