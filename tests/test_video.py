"""Hand-built viewing sessions, merge modes, options, and hot sessions."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from oracle import bindings
from clickloom.operators.ordered import HotGroups
from clickloom.plans import enrich, video
from conftest import SMALL, rows

START = datetime(2024, 5, 1, 12)
SCHEMA = (
    "timestamp timestamp, gpn string, session_id string, CP_Video_Action string, CP_Video_Id string, "
    "CP_Video_Duration string, CP_Video_PlayedTime string"
)


def viewing(spark, *steps, gpn="00000001", session="s", video_id="v", duration="100"):
    """Steps are (seconds since start, action, position)."""
    data = [
        (START + timedelta(seconds=t), gpn, session, action, video_id, duration, pos)
        for t, action, pos in steps
    ]
    return spark.createDataFrame(data, SCHEMA)


def segs(df, **options):
    return video.segments(video.video_events(df), **options)


def valid(df):
    return [r.is_valid_segment for r in segs(df).orderBy("timestamp").collect()]


def test_filter_and_normalize(spark):
    df = viewing(
        spark,
        (0, " Play ", "0"),
        (1, "seek", "0"),
        (2, None, "0"),
        (3, "PAUSE", "bad"),
    ).unionByName(viewing(spark, (0, "play", "0"), video_id="  ")).unionByName(
        viewing(spark, (0, "play", "0"), gpn="")
    )
    assert rows(video.video_events(df).select("action", "current_time_pos")) == [
        ("pause", None),
        ("play", 0.0),
    ]


@pytest.mark.parametrize(
    ("steps", "expected"),
    [
        ([(0, "play", "0"), (10, "pause", "10")], [True]),
        ([(0, "resume", "5"), (10, "ended", "15")], [True]),
        ([(0, "pause", "0"), (10, "pause", "10")], [False]),
        ([(0, "play", "10"), (10, "pause", "5")], [False]),  # backward
        ([(0, "play", "10"), (10, "pause", "10")], [False]),  # no progress
        ([(0, "play", "0"), (9000, "pause", "7200")], [False]),  # too long
        ([(0, "play", "0"), (10, "pause", "15")], [True]),  # clock tolerance
        ([(0, "play", "0"), (10, "pause", "15.1")], [False]),
        ([(0, "play", None), (10, "pause", "15")], [None]),  # unknown position
    ],
)
def test_valid_segments(spark, steps, expected):
    assert valid(viewing(spark, *steps)) == expected


def test_jump_types(spark):
    df = viewing(
        spark, (0, "play", "0"), (10, "pause", "10"), (11, "play", "7"), (12, "pause", "8")
    )
    types = [r.jump_type for r in segs(df).orderBy("timestamp").collect()]
    assert types == ["forward", "backward", "none"]
    exempt = segs(df, valid_is_no_skip=True).orderBy("timestamp").collect()
    assert [r.jump_type for r in exempt] == ["none", "backward", "none"]


CONTAINED = [
    (0, "play", "0"), (100, "pause", "100"), (200, "play", "10"), (210, "pause", "20"),
    (300, "play", "50"), (310, "pause", "60"),
]


def test_interval_merge_modes(spark):
    s = segs(viewing(spark, *CONTAINED))
    assert video.unique_seconds(s, "lag").first().unique_seconds_watched == 110.0
    assert video.unique_seconds(s, "running_max").first().unique_seconds_watched == 100.0


def test_first_event_is_dropped_unless_asked_for(spark):
    df = viewing(spark, (0, "play", "0"))
    assert segs(df).count() == 0
    kept = segs(df, count_first_event=True)
    assert video.views(kept).first().total_views == 1
    assert kept.first().watched_seconds == 0.0


def test_views(spark):
    resumed = viewing(spark, (0, "pause", "0"), (5, "resume", "0"), (15, "pause", "10"))
    assert video.views(segs(resumed)).first().total_views == 1
    invalid = viewing(spark, (0, "pause", "0"), (5, "resume", "0"), (15, "pause", "0"))
    assert video.views(segs(invalid)).first().total_views == 0
    plays = viewing(spark, (0, "pause", "0"), (5, "play", "0"), (6, "play", "0"), (7, "resume", "0"))
    assert video.views(segs(plays)).first().total_views == 2


def test_session_without_id(spark):
    s = segs(viewing(spark, (0, "play", "0"), (10, "pause", "10"), session=None))
    found = video.sessions(s, video.unique_seconds(s)).first()
    assert (found.watch_time, found.unique_seconds_watched) == (10.0, 0.0)


def test_latest_metadata_may_be_null(spark):
    df = viewing(spark, (0, "play", "0"), (1, "pause", "1")).withColumn(
        "CP_Video_Title", F.when(F.col("CP_Video_Action") == "play", "old title")
    )
    found = video.metadata(video.video_events(df)).first()
    assert found.latest_title is None and found.reported_duration == 100.0


def test_engagement_values(spark):
    df = viewing(spark, (0, "play", "0"), (90, "pause", "90"), (91, "resume", "90"), (99, "ended", "98"))
    r = video.video_engagement(df).first()
    assert (r.total_watch_time, r.unique_seconds_watched, r.max_position_reached) == (98.0, 98.0, 98.0)
    assert (r.watch_percentage, r.completion_count, r.is_completed) == (98.0, 1, True)
    assert r.engagement_score == round(98 / 60 + 50 + 5 - 2 * 2, 2)  # two forward moves
    assert (r.engagement_tier, r.data_quality_flag, r.is_replay) == ("Medium", "ok", False)
    short = viewing(spark, (0, "play", "0"), (3, "pause", "3"), duration=None)
    r = video.video_engagement(short).first()
    assert (r.video_duration, r.data_quality_flag) == (3.0, "very_short_watch")
    gaming = viewing(spark, (0, "play", "0"), (10, "ended", "10"))
    assert video.video_engagement(gaming).first().data_quality_flag == "completed_without_sufficient_watch"
    over = viewing(spark, *CONTAINED, duration="90")
    assert video.video_engagement(over).first().data_quality_flag == "excessive_watch_time"
    still = viewing(spark, (0, "play", "0"), (10, "pause", "0"), duration=None)
    assert video.video_engagement(still).first().watch_percentage is None


@pytest.mark.parametrize("mode", ["lag", "running_max"])
def test_hot_sessions_are_split_without_change(spark, mode):
    """Half of all events move into one blank person's session of one video."""
    source_rows = bindings.click_events(spark, SMALL)
    hot = F.col("event_id") < 500
    skewed = source_rows.withColumns(
        {
            "CP_GPN": F.when(hot, "").otherwise(F.col("CP_GPN")),
            "session_id": F.when(hot, None).otherwise(F.col("session_id")),
            "CP_Video_Id": F.when(hot, "v0").otherwise(F.col("CP_Video_Id")),
        }
    )
    events = enrich.with_session_columns(skewed)
    whole = video.segments(video.video_events(events), hot=None)
    split = video.segments(video.video_events(events), hot=HotGroups(30, 60, 16))
    assert rows(split.select(sorted(whole.columns))) == rows(whole.select(sorted(whole.columns)))
    seconds = F.round("unique_seconds_watched", 6).alias("s")
    merged = video.unique_seconds(whole, mode, None).select(*video.VIEWING, seconds)
    merged_split = video.unique_seconds(split, mode, HotGroups(3, 50, 16)).select(*video.VIEWING, seconds)
    assert rows(merged) == rows(merged_split)


def test_merged_seconds_are_bounded(spark):
    events = enrich.with_session_columns(bindings.click_events(spark, SMALL))
    s = segs(events)
    union = video.unique_seconds(s, "running_max")
    bounds = s.where("is_valid_segment").groupBy(*video.VIEWING).agg(
        F.sum("watched_seconds").alias("watched"),
        (F.max("current_time_pos") - F.min("prev_time_pos")).alias("span"),
    )
    joined = union.join(bounds, video.VIEWING)
    assert joined.count() == union.count() > 0
    over = (F.col("unique_seconds_watched") > F.col("watched") + 1e-6) | (
        F.col("unique_seconds_watched") > F.col("span") + 1e-6
    )
    assert joined.where(over).count() == 0
