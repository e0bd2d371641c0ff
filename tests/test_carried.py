"""As-of joins with snapshots at any time, and most frequent keys without a count of all keys."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickloom.operators.carried import asof_time
from clickloom.operators.frequent import BUCKET, most_frequent, possible
from clickloom.operators.ordered import HotGroups
from conftest import rows

START = datetime(2024, 1, 1)
FIELDS = {"a": "told_a", "b": "told_b"}
EVENTS = "id long, who string, at timestamp, told_a string"
SNAPSHOTS = "who string, taken timestamp, a string, b string"


def brute_force(events, snapshots):
    known = {}
    for who, taken, *told in snapshots:
        if who is not None and taken is not None:
            days = known.setdefault(who, {})
            days[taken] = max(days.get(taken, ()), tuple(told), key=lambda t: [(x is not None, x or "") for x in t])
    for id_, who, at, _ in events:
        days = sorted(known.get(who, {}).items())
        passed = 0 if at is None else sum(t <= at for t, _ in days)
        matched = days[passed - 1][1] if passed else (None, None)
        later = days[passed][1] if passed < len(days) else (None, None)
        yield id_, who, at, *(m if m is not None else n for m, n in zip(matched, later))


def made_up(seed: int):
    rng = random.Random(seed)
    people = [None, "hot", "hot", "hot", "b", "c", "only events"]

    def time():
        return None if rng.random() < 0.05 else START + timedelta(hours=6 * rng.randrange(200))

    snapshots = [
        (rng.choice(people[:6]), time(), *(rng.choice([None, "x", "y", "z"]) for _ in FIELDS)) for _ in range(150)
    ]
    events = [(i, rng.choice(people), time(), "old") for i in range(400)]
    return events + events[:20], snapshots


@pytest.mark.parametrize("policy", [None, HotGroups(), HotGroups(min_rows=40, slice_rows=15, buckets=4)])
def test_daily_snapshots(spark, policy):
    events, snapshots = made_up(3)
    got = asof_time(
        spark.createDataFrame(events, EVENTS), spark.createDataFrame(snapshots, SNAPSHOTS), "who",
        F.col("at"), F.col("taken"), FIELDS, policy,
    )
    assert got.columns == ["id", "who", "at", "told_a", "told_b"]
    assert rows(got) == sorted(brute_force(events, snapshots), key=repr)


def test_without_snapshots_or_events(spark):
    events, snapshots = made_up(4)
    e, s = spark.createDataFrame(events, EVENTS), spark.createDataFrame(snapshots, SNAPSHOTS)
    nothing = asof_time(e, s.limit(0), "who", F.col("at"), F.col("taken"), FIELDS)
    assert rows(nothing) == sorted(((*x[:3], None, None) for x in events), key=repr)
    assert asof_time(e.limit(0), s, "who", F.col("at"), F.col("taken"), FIELDS).count() == 0


SKEWED = [f"k{i}" for i in range(20) for _ in range(600 - 10 * i)] + [f"rare{i}" for i in range(3000)] + [None] * 595
FLAT = [f"k{i}" for i in range(2000) for _ in range(3)]


@pytest.mark.parametrize("values, k", [(SKEWED, 5), (SKEWED, 20), (FLAT, 7), (["a", "a", None], 5), ([], 5)])
def test_most_frequent_is_exact(spark, values, k):
    table = spark.createDataFrame([(v, 1) for v in values], "`a.key` string, other int").repartition(4)
    got = [tuple(r) for r in most_frequent(table, ["a.key"], k, "n", buckets=256).collect()]
    counts = sorted(Counter(values).items(), key=lambda c: (-c[1], c[0] is not None, c[0]))
    assert got == counts[:k]


def test_only_certified_buckets_are_counted(spark):
    def left(values, k):
        keyed = spark.createDataFrame([(v,) for v in values], "key string")
        return possible(keyed.withColumn(BUCKET, F.pmod(F.xxhash64("key"), F.lit(1024))), ["key"], k)

    assert left(SKEWED, 5).select("key").distinct().count() < 60
    assert left(FLAT, 7).count() >= 7 * 3
