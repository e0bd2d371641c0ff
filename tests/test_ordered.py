"""Split hot groups must give what one window over the whole group gives."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators.ordered import HotGroups, Ordered, add_ordered, hot_groups
from conftest import rows

SPLIT = HotGroups(min_rows=20, slice_rows=60, buckets=64)


def events(spark, seed=1):
    """One key with a third of the rows, a NULL key, copies of one row, and many small keys."""
    rnd = random.Random(seed)
    data = [("hot", rnd.randrange(50), rnd.choice("abc"), rnd.random()) for _ in range(200)]
    data += [(None, rnd.randrange(50), rnd.choice("abc"), rnd.random()) for _ in range(60)]
    data += [("copies", 7, "a", 1.0)] * 90
    data += [("hot", None, "z", 2.0)] * 2
    data += [(f"k{i % 80}", rnd.randrange(9), "a", rnd.random()) for i in range(250)]
    rnd.shuffle(data)
    return spark.createDataFrame(data, "key string, t int, name string, v double").repartition(6)


def brute_force(data, order):
    """(previous v, highest v before, position, running sum of position parity) per row."""
    groups: dict = {}
    for r in data:
        groups.setdefault(r.key, []).append(r)
    out = []
    for group in groups.values():
        group.sort(key=lambda r: tuple((r[c] is None, r[c] if r[c] is not None else 0) for c in order))
        best, total = None, 0
        for i, r in enumerate(group):
            total += (i + 1) % 2
            out.append((*r, group[i - 1].v if i else None, best, i + 1, (i + 1) % 2, total))
            best = r.v if best is None else max(best, r.v)
    return sorted(out, key=repr)


@pytest.mark.parametrize("policy", [None, HotGroups(), SPLIT, HotGroups(5, 30, 4)])
def test_split_equals_brute_force(spark, policy):
    df = events(spark)
    order = ["t", "name", "v"]
    wanted = Ordered(
        lags={"prev_v": "v"},
        max_before={"best_before": "v"},
        position="n",
        derive=lambda d: d.withColumn("odd", F.col("n") % 2),
        running_sum={"odd_so_far": "odd"},
    )
    got = add_ordered(df, ["key"], order, wanted, policy)
    got = got.select("key", "t", "name", "v", "prev_v", "best_before", "n", "odd", "odd_so_far")
    assert rows(got) == brute_force(df.collect(), order)


@pytest.mark.parametrize("buckets", [1, 64, 65_536])
def test_every_group_above_the_limit_is_hot(spark, buckets):
    df = events(spark)
    found = hot_groups(df, ["key"], HotGroups(20, 60, buckets)).collect()
    assert {(r.key, r["__rows"]) for r in found} == {("hot", 202), (None, 60), ("copies", 90)}
    sizes = df.groupBy("key").count().where("count > 2").count()
    assert hot_groups(df, ["key"], HotGroups(2, 60, buckets)).count() == sizes
    assert hot_groups(df, ["key"], HotGroups(300, 60, buckets)) is None


def test_no_split_leaves_a_plain_window(spark):
    df = events(spark)
    plan = add_ordered(df, ["key"], ["t"], Ordered(lags={"p": "v"}))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("Window ") == 1
