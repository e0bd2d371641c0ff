"""The composed views: evenly dealt to as many tasks as their rows need, and the rows of the SQL text."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions import parse_export_time
from clickloom.sources.files import is_time
from conftest import SMALL, rows
from oracle import bindings, deliveries


def test_tasks_that_compose_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(bindings, "TASK_ROWS", 40)
    for compose in (bindings.compose_log, bindings.compose_click_events):
        sizes = compose(spark, SMALL).groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 25  # 1,000 rows, which lie in one row group
        assert max(r["count"] for r in sizes) <= 80


def test_log_composed_by_column_is_the_log_of_the_text(spark):
    text = bindings._base(spark, SMALL).select("event_id", F.expr(bindings.details_json()).alias("customDimensions"))
    assert rows(bindings.compose_log(spark, SMALL).select("event_id", "customDimensions")) == rows(text)


def test_every_delivered_file_has_a_task_of_its_own(spark):
    dealt = deliveries._dealt(spark.range(30_000).withColumnRenamed("id", "event_id"))
    met = dealt.groupBy(F.spark_partition_id().alias("task")).agg(F.collect_set("part").alias("parts")).collect()
    assert sorted(r.parts for r in met) == [[0], [1], [2], [3]]


def test_only_the_format_with_the_separator_of_a_text_is_tried(spark):
    texts = ["31.01.2024", "31/01/2024 10:00", "2024-01-31", " 31.01.2024 ", "31-01-2024", "31.01/2024", "", None, "2024-01-31T10:00:00"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    parsed = frame.select("t", parse_export_time(F.col("t")).cast("string").alias("p"), is_time(F.col("t")).alias("is"))
    day = "2024-01-31 00:00:00"
    assert [r.p for r in parsed.collect()] == [day, "2024-01-31 10:00:00", day, day, None, None, None, None, "2024-01-31 10:00:00"]
    assert [r["is"] for r in parsed.collect()] == [r.p is not None for r in parsed.collect()]
    plan = frame.select(parse_export_time(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    attempts = plan.lower().count("gettimestamp")
    assert attempts >= 2 and plan.lower().count("substring(") >= 2, plan
