"""Tables replaced by partition, keys that never change, sessions and facts that follow deliveries."""

from __future__ import annotations

import tempfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from clickloom.plans import enrich, maintain, star, video
from clickloom.sources.parts import PartitionedTable
from clickloom.sources.registry import KeyRegistry
from conftest import rows


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


def table_of(spark, *data):
    return spark.createDataFrame(data, "day date, v string")


D1, D2, D3 = date(2024, 5, 1), date(2024, 5, 2), date(2024, 5, 3)


def test_partitions_are_replaced_aside(spark, folder):
    table = PartitionedTable(spark, folder, "day")
    assert table.read() is None and table.current() == 0
    table.replace(table_of(spark, (D1, "a"), (D2, "b"), (None, "n")))
    before = table.read()
    assert table.replace(table_of(spark, (D2, "c")), [D2, D3]) == 2
    assert rows(table.read()) == sorted([(D1, "a"), (D2, "c"), (None, "n")], key=repr)
    assert rows(before) == rows(table.read(1))  # a reader of the version before is not disturbed
    assert table.parts() == {"day=2024-05-01": 1, "day=2024-05-02": 2, "day=__HIVE_DEFAULT_PARTITION__": 1}
    table.replace(table_of(spark), [None, D1])  # partitions without rows go
    assert rows(table.read()) == [(D2, "c")] == rows(table.read(values=[D2, D3]))
    assert table.read(values=[D1]).count() == 0
    with pytest.raises(ValueError, match="not to be replaced"):
        table.replace(table_of(spark, (D1, "x")), [D2])
    assert rows(table.read()) == [(D2, "c")]  # and what that run left behind does not count
    table.replace(table_of(spark, (D3, "d")), [D3])
    gone = table.forget_before(table.current())
    assert gone and rows(table.read()) == [(D2, "c"), (D3, "d")]


def test_keys_keep_their_numbers(spark, folder):
    registry = KeyRegistry(spark, folder)

    def keys(*found):
        return spark.createDataFrame([(d, list(p)) for d, p in found], "dim string, parts array<string>")

    def numbers(df):
        return {(r.dim, tuple(r.parts)): r.number for r in df.collect()}

    first = numbers(registry.register(keys(("a", ["m"]), ("a", ["z"]), ("b", ["x", None]))))
    assert first == {("a", ("m",)): 1, ("a", ("z",)): 2, ("b", ("x", None)): 1}
    second = numbers(registry.register(keys(("a", ["b"]), ("a", ["m"]), ("b", ["x", None]), ("b", ["x", ""]), ("c", ["q"]))))
    assert second == first | {("a", ("b",)): 3, ("b", ("x", "")): 2, ("c", ("q",)): 1}
    # Nothing new, and a folder that a dead run left: nothing changes, and its number is not taken again.
    keys(("a", ["lost"])).withColumn("number", F.lit(9).cast("long")).write.parquet(f"{folder}/version=3")
    import os

    os.remove(f"{folder}/version=3/_SUCCESS")
    assert numbers(registry.register(keys(("a", ["b"])))) == second
    third = numbers(registry.register(keys(("a", ["lost"]))))
    assert third == second | {("a", ("lost",)): 4}


SCHEMA = (
    "timestamp timestamp, name string, user_id string, session_id string, CP_GPN string, CP_Video_Action string, "
    "CP_Video_Id string, CP_Video_PlayedTime double, CP_Video_Duration double, CP_Video_Title string"
)


def clicks(spark, *data):
    made = [(t, "click_event", "u", s, g, a, v, p, 100.0, title) for t, s, g, a, v, p, title in data]
    df = spark.createDataFrame(made, SCHEMA.replace("timestamp timestamp", "timestamp string"))
    return enrich.enrich(df.withColumn("timestamp", F.col("timestamp").cast("timestamp")))


OLD = [
    ("2024-05-01 10:00:00", "s1", "1", "play", "v", 0.0, "first"),
    ("2024-05-01 10:00:30", "s1", "1", "pause", "v", 30.0, "first"),
    ("2024-05-01 11:00:00", "s2", "2", "play", "v", 0.0, "other"),
    ("2024-05-01 11:00:20", "s2", "2", "pause", "v", 20.0, "other"),
    ("2024-05-02 09:00:00", "s3", "1", "play", "w", 5.0, None),  # alone: counts only once another event follows
    ("2024-05-01 12:00:00", None, "3", "play", "v", 0.0, "x"),
    ("2024-05-01 12:00:10", None, "3", "ended", "v", 10.0, "x"),
    ("2024-05-02 21:59:50", "s4", "4", "play", "v", 0.0, "night"),  # goes on after local midnight
]
NEW = [
    ("2024-05-03 10:00:00", "s1", "1", "resume", "v", 30.0, "renamed"),
    ("2024-05-03 10:00:25", "s1", "1", "ended", "v", 55.0, "renamed"),
    ("2024-05-03 09:00:10", "s3", "1", "pause", "w", 15.0, None),
    ("2024-05-03 12:00:00", None, "3", "play", "v", 10.0, "x"),
    ("2024-05-02 22:00:05", "s4", "4", "pause", "v", 15.0, "night"),
]


def engaged(df):
    return rows(df.select(*[F.col(c).cast("string") for c in df.columns]))


def test_sessions_follow_deliveries(spark, folder):
    table = maintain.session_table(spark, folder)
    maintain.update_sessions(table, clicks(spark, *OLD), None)
    both = clicks(spark, *OLD, *NEW)
    states = maintain.update_sessions(table, both, [D3])
    assert engaged(video.engagement_of_sessions(states)) == engaged(video.video_engagement(both))
    assert states.count() == 5
    # Sessions that begin on days no affected session begins on are not written again.
    assert maintain.update_sessions(table, both, []).count() == 5
    late = clicks(spark, *OLD, *NEW, ("2024-05-04 10:00:00", "s9", "9", "play", "v", 0.0, "z"))
    maintain.update_sessions(table, late, [date(2024, 5, 4)])
    assert {p for p, v in table.parts().items() if v == table.current()} == {"first_date=2024-05-04"}
    # Rows that went: a day's events are gone, the sessions they made as well.
    less = both.where(F.col("session_date") != D3)
    states = maintain.update_sessions(table, less, [D3, date(2024, 5, 4)])
    assert engaged(video.engagement_of_sessions(states)) == engaged(video.video_engagement(less))


def test_facts_follow_deliveries(spark, folder):
    table, registry = maintain.fact_table(spark, folder), maintain.key_registry(spark, folder)
    maintain.update_facts(table, registry, clicks(spark, *OLD), None, "p")
    first = table.current()
    both = clicks(spark, *OLD, *NEW)
    dims = maintain.update_facts(table, registry, both, [D3], "p")
    assert {p for p, v in table.parts().items() if v != first} == {"session_date=2024-05-03"}
    assert rows(table.read().drop("session_date")) == rows(star.fact_event(both, dims, "p"))
    assert [r.date_key for r in dims.dim_date.orderBy("date_value").collect()] == [1, 2, 3]
    # An earlier day that comes late gets the next number.
    more = clicks(spark, ("2024-04-01 10:00:00", "s0", "1", "play", "v", 0.0, "t"), *OLD, *NEW)
    dims = maintain.update_facts(table, registry, more, [date(2024, 4, 1)], "p")
    assert [r.date_key for r in dims.dim_date.orderBy("date_value").collect()] == [4, 1, 2, 3]
    assert table.read().count() == more.count()
