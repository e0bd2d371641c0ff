"""The log by day, its way into the event store, and sketches that add up."""

from __future__ import annotations

import json
import tempfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clickloom.plans import sketches
from clickloom.plans.ingest import ingest, ingest_log
from clickloom.operators.flatten import export_view, flatten
from clickloom.sources.log import log_table, recent_log, store_log
from clickloom.sources.store import EventStore
from clickloom.streaming import log_stream
from clickloom.streaming.log_stream import log_files, stream_log
from conftest import rows

SCHEMA = (
    "timestamp string, name string, client_CountryOrRegion string, user_Id string, session_Id string, customDimensions string"
)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


def log(spark, *data):
    made = [(t, name, "DE", user, "s", json.dumps({"CustomProps": json.dumps(p)})) for t, name, user, p in data]
    return spark.createDataFrame(made, SCHEMA).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


FIRST = [
    ("2024-05-01 10:00:00.123456", "click_event", "u1", {"GPN": "007", "Topic": "a", "Seen": "2024-01-01"}),
    ("2024-05-01 11:00:00", "page_view", "u2", {"GPN": "8"}),
    ("2024-05-02 09:00:00", "click_event", "u1", {"GPN": "007", "Topic": ""}),
]
LATER = [("2024-05-02 10:00:00", "click_event", "u3", {"gpn": "9", "Topic": None, "Seen": "soon"})]


def test_log_and_export_give_the_same_events(spark, folder):
    table, store = log_table(spark, f"{folder}/log"), EventStore(spark, f"{folder}/store")
    assert ingest_log(store, table) is None
    store_log(table, log(spark, *FIRST))
    first = ingest_log(store, table)
    assert first.files == {"log/2024-05-01": "new", "log/2024-05-02": "new"}
    assert first.row_counts == {"log/2024-05-01": 1, "log/2024-05-02": 1}
    assert ingest_log(store, table) is None
    store_log(table, log(spark, *LATER))
    second = ingest_log(store, table)
    assert second.files == {"log/2024-05-02": "changed"} and second.widened == ["CP_Seen"]
    # The same rows as two export files.
    exports = EventStore(spark, f"{folder}/other")
    clicks = [d for d in FIRST if d[1] == "click_event"]
    for name, data in (("a_2024_05_01", clicks), ("b_2024_05_02", [clicks[-1], *LATER])):
        written = f"{folder}/csv-{name}"
        export_view(flatten(log(spark, *data))).coalesce(1).write.option("header", True).csv(written)
        import glob
        import os

        os.makedirs(f"{folder}/in", exist_ok=True)
        os.rename(glob.glob(f"{written}/part-*.csv")[0], f"{folder}/in/{name}.csv")
    ingest(spark, exports, f"{folder}/in")
    one, other = store.events(), exports.events()
    # In the second file the one spelling of the key is alone and has no number.
    assert one.where("CP_gpn_1 = '9'").count() == 1
    same = ["timestamp", "user_id", "session_id", "name", "CP_Topic", "CP_Seen"]
    assert rows(one.select(same)) == rows(other.select(same))


def test_a_first_ingest_joins_no_keys(spark, folder, monkeypatch):
    """Days of the log are one delivery: into an empty store it is written as it is, later its keys replace those of the store."""
    from clickloom.operators import upsert

    made = []
    monkeypatch.setattr(upsert, "materialize", lambda df, label, real=upsert.materialize: made.append(label) or real(df, label))
    table, store = log_table(spark, f"{folder}/log"), EventStore(spark, f"{folder}/store")
    twice = [*FIRST, FIRST[2], (None, "click_event", "u5", {"GPN": "5"})]
    store_log(table, log(spark, *twice))
    told = ingest_log(store, table)
    assert made == []
    assert told.row_counts == {"log/2024-05-01": 1, "log/2024-05-02": 2, "log/None": 1}
    store_log(table, log(spark, *LATER))
    ingest_log(store, table)
    assert made == ["delivered-keys"]
    assert sorted(r["user_id"] for r in store.events().collect()) == ["u1", "u1", "u1", "u3", "u5"]
    assert "__rank" not in store.stored().columns


def test_only_recent_days_are_opened(spark, folder):
    table = log_table(spark, folder)
    assert recent_log(table, datetime(2024, 5, 3), 1) is None
    store_log(table, log(spark, *FIRST))
    store_log(table, log(spark, *LATER))
    got = recent_log(table, datetime(2024, 5, 3), 1)
    assert got.count() == 2
    assert {f.split("log_day=")[1][:10] for f in got.inputFiles()} == {"2024-05-02"}
    store_log(table, log(spark, *LATER), replace=True)
    assert recent_log(table, datetime(2024, 5, 3), 1).count() == 1
    assert table.read().count() == 3


def test_sketches_of_days_add_up(spark, folder):
    table, values = tables = sketches.sketch_tables(spark, folder)
    data = [(f"2024-05-{d:02d} 10:00:00", "click_event", f"u{i}", {"GPN": str(i % 7), "K": str(i)}) for d in (1, 2, 3) for i in range(40)]
    sketches.update(tables, log(spark, *data), None, "p")
    got = sketches.visits(table, date(2024, 5, 1), date(2024, 5, 2)).first()
    assert (got.total_events, got.users, got.gpns, got.hashes, got.countries) == (80, 40, 7, 7, 1)
    more = log(spark, *data[:40], ("2024-05-01 12:00:00", "click_event", "other", {"GPN": "", "K": ""}))
    sketches.update(tables, more, [date(2024, 5, 1)], "p")
    assert sketches.visits(table, date(2024, 5, 1), date(2024, 5, 9)).first().users == 41
    assert rows(sketches.property_values(values, date(2024, 5, 1), date(2024, 5, 2))) == [("GPN", 81, 8, ""), ("K", 81, 41, "")]
    assert sketches.visits(table, date(2025, 1, 1), date(2025, 1, 2)).first().total_events == 0


def test_micro_batches_equal_one_batch(spark, folder, monkeypatch):
    """Also when a run dies between storing a batch and merging it."""
    for i, data in enumerate((FIRST, LATER)):
        log(spark, *data).coalesce(1).write.mode("append").parquet(f"{folder}/files")
    schema = log(spark, *FIRST).schema

    def run(store, table):
        stream_log(log_files(spark, f"{folder}/files", schema, 1), table, store, f"{folder}/checkpoint", "test-log")

    table, store = log_table(spark, f"{folder}/log"), EventStore(spark, f"{folder}/store")

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(log_stream, "ingest_log", dies)
        with pytest.raises(Exception, match="lost"):
            run(store, table)
    assert store.current().number == 0 and table.current() == 1
    run(store, table)  # the batch that was stored comes again
    assert table.read().count() == len(FIRST) + len(LATER)
    whole, other = log_table(spark, f"{folder}/whole"), EventStore(spark, f"{folder}/other")
    store_log(whole, log(spark, *FIRST, *LATER))
    ingest_log(other, whole)
    columns = ["timestamp", "user_id", "name", "CP_GPN", "CP_Topic", "CP_Seen"]
    assert rows(store.events().select(columns)) == rows(other.events().select(columns))
    before = store.current()
    run(store, table)  # nothing new
    assert store.current() == before
