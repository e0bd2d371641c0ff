"""Delta detection, ordering, upsert and crash behaviour on small export files."""

from __future__ import annotations

import os
import tempfile
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clickloom.operators.upsert import upsert
from clickloom.plans.ingest import ingest
from clickloom.sources import files
from clickloom.sources.store import EventStore
from conftest import rows

HEADER = "timestamp [UTC],name,client_CountryOrRegion,user_Id,session_Id,CP_GPN,CP_Link_label"


def line(ts, user="u1", session="s1", gpn="00001234", label="one", name="click_event"):
    return f"{ts},{name},DE,{user},{session},{gpn},{label}"


def export(folder: Path, name: str, *lines: str, header: str = HEADER, mtime: int | None = None):
    path = folder / name
    path.write_bytes(("﻿" + "\r\n".join([header, *lines]) + "\r\n").encode())
    if mtime:
        os.utime(path, (mtime, mtime))
    return path


@pytest.fixture
def folder():
    return Path(tempfile.mkdtemp(prefix="run-"))


@pytest.fixture
def store(spark):
    return EventStore(spark, tempfile.mkdtemp(prefix="run-"))


def labels(store):
    return rows(store.events().select(F.col("timestamp").cast("string"), "CP_Link_label"))


def test_listing_order_dates_and_hashes(spark, folder):
    undated_late = export(folder, "late.csv", line("01/02/2026 10:00:00.1234567"), mtime=2_000_000_000)
    export(folder, "early.csv", line("01/02/2026 10:00:00.1234567"), mtime=1_000_000_000)
    export(folder, "export_2026_02_25.csv", line("x"))
    export(folder, "export_2026_01_25.csv", line("x"))
    export(folder, "export_2026_02_30.csv", line("x"), mtime=1_500_000_000)
    (folder / "notes.txt").write_text("not an export")
    found = files.pending(spark, str(folder), None)
    assert [e.filename for e in found] == [
        "export_2026_01_25.csv",
        "export_2026_02_25.csv",
        "early.csv",
        "export_2026_02_30.csv",
        "late.csv",
    ]
    assert [e.date_suffix for e in found[:3]] == [date(2026, 1, 25), date(2026, 2, 25), None]
    assert found[-1].length == undated_late.stat().st_size
    assert len({e.file_hash for e in found}) == 2  # three files have one content
    assert found[0].header == tuple(HEADER.split(","))


def test_delta_scenarios(spark, folder, store):
    export(folder, "c_2026_02_01.csv", line("01/02/2026 10:00:00.1234567"))
    export(
        folder,
        "c_2026_02_02.csv",
        line("01/02/2026 10:00:00.1234567", label="two"),
        line("02/02/2026 09:00:00.0000001", label="two"),
    )
    first = ingest(spark, store, str(folder))
    assert set(first.files.values()) == {"new"} and len(first.files) == 2
    assert first.row_counts == {"c_2026_02_01.csv": 1, "c_2026_02_02.csv": 2}
    expected = [("2026-02-01 10:00:00.123456", "two"), ("2026-02-02 09:00:00", "two")]
    assert labels(store) == expected

    assert ingest(spark, store, str(folder)) is None  # nothing new

    export(folder, "c_2026_02_03.csv", line("03/02/2026 09:00:00.5", label="three"))
    assert ingest(spark, store, str(folder)).files == {"c_2026_02_03.csv": "new"}
    assert len(labels(store)) == 3  # earlier days are still there

    export(folder, "c_2026_02_02.csv", line("02/02/2026 09:00:00.0000001", label="changed"))
    assert ingest(spark, store, str(folder)).files == {"c_2026_02_02.csv": "changed"}
    assert ("2026-02-02 09:00:00", "changed") in labels(store)
    assert ("2026-02-01 10:00:00.123456", "two") in labels(store)  # rows gone from a file stay

    before = labels(store)
    forced = ingest(spark, store, str(folder / "c_2026_02_03.csv"), mode="file")
    assert forced.files == {"c_2026_02_03.csv": "forced"}
    assert labels(store) == before  # the same file again changes nothing

    report = store.processed_report().select("filename", "row_count", "date_suffix").collect()
    assert [r.filename for r in report] == [f"c_2026_02_0{i}.csv" for i in (1, 2, 3)]
    assert [r.row_count for r in report] == [1, 1, 1]

    refreshed = ingest(spark, store, str(folder), mode="full_refresh")
    assert len(refreshed.files) == 3 and refreshed.version.generation == 2
    assert labels(store) == [
        ("2026-02-01 10:00:00.123456", "one"),
        ("2026-02-02 09:00:00", "changed"),
        ("2026-02-03 09:00:00.5", "three"),
    ]


def test_only_touched_days_are_written(spark, folder, store):
    export(folder, "a_2026_02_01.csv", line("01/02/2026 10:00:00.1"), line("02/02/2026 10:00:00.1"))
    ingest(spark, store, str(folder))
    export(folder, "a_2026_02_02.csv", line("02/02/2026 11:00:00.1"))
    done = ingest(spark, store, str(folder))
    written = store.folders.children(store._data(done.version))
    assert written == ["event_date=2026-02-02"]
    assert store.events().count() == 3
    # What no later version reads can go.
    gone = store.forget_before(done.version)
    assert [p.split("/generation=1/")[1] for p in gone] == ["data/version=1/event_date=2026-02-02", "commits/version=1"]
    assert store.events().count() == 3
    export(folder, "a_2026_02_03.csv", line("01/02/2026 12:00:00.1"))
    ingest(spark, store, str(folder))
    assert store.events().count() == 4


def test_interrupted_run_changes_nothing(spark, folder, store):
    export(folder, "a_2026_02_01.csv", line("01/02/2026 10:00:00.1"))
    ingest(spark, store, str(folder))
    before, version = labels(store), store.current()
    # data of the next version was written, but its manifest never was
    store.write_days(store.events().withColumn("CP_Link_label", F.lit("lost")), store.next())
    assert store.current() == version and labels(store) == before
    export(folder, "a_2026_02_02.csv", line("01/02/2026 11:00:00.1", label="later"))
    done = ingest(spark, store, str(folder))
    assert done.version.number == version.number + 2
    assert [label for _, label in labels(store)] == ["one", "later"]


def test_headers_differ_between_files(spark, folder, store):
    export(folder, "a_2026_02_01.csv", line("01/02/2026 10:00:00.1"))
    export(
        folder,
        "a_2026_02_02.csv",
        "new,click_event,01.02.2026 10:05,u1,s1",
        header="CP_Topic,name,timestamp [UTC],user_Id,session_Id",
    )
    ingest(spark, store, str(folder))
    export(
        folder,
        "a_2026_02_03.csv",
        "theme,click_event,2026-02-01T10:06:00,u1,s1",
        header="CP_Theme,name,timestamp [UTC],user_Id,session_Id",
    )
    ingest(spark, store, str(folder))
    got = store.events().select(F.col("timestamp").cast("string"), "CP_GPN", "CP_Topic", "CP_Theme")
    assert rows(got) == [
        ("2026-02-01 10:00:00.1", "00001234", None, None),
        ("2026-02-01 10:05:00", None, "new", None),
        ("2026-02-01 10:06:00", None, None, "theme"),
    ]


def test_quoted_fields_and_bad_times(spark, folder, store):
    export(
        folder,
        "a_2026_02_01.csv",
        line("01/02/2026 10:00:00.1", label='"two\nlines, and ""quotes"""'),
        line("soon", label='""'),
        line("", label="no time"),
    )
    ingest(spark, store, str(folder))
    assert rows(store.events().select("CP_Link_label")) == [
        ("no time",),
        ('two\nlines, and "quotes"',),
        (None,),
    ]
    quality = files.time_quality(store.events()).first()
    assert (quality.total, quality.without_time, quality.with_fraction) == (3, 2, 1)


def test_files_are_split_unless_fields_span_lines(spark, folder, store):
    many = [line(f"01/02/2026 10:00:{i:02d}.5", label=f"n{i}") for i in range(40)]
    export(folder, "plain_2026_02_01.csv", *many)
    export(folder, "span_2026_02_02.csv", line("02/02/2026 10:00:00.5", label='"a\nb"'), *many[:3])
    found = {e.filename: e for e in files.pending(spark, str(folder), None)}
    assert not found["plain_2026_02_01.csv"].in_one_piece
    assert found["span_2026_02_02.csv"].in_one_piece
    ingest(spark, store, str(folder))
    assert store.events().count() == 40 + 1
    assert store.events().where(F.col("CP_Link_label") == "a\nb").count() == 1
    assert ingest(spark, store, str(folder)) is None
    export(folder, "plain_2026_02_01.csv", *many[:-1], line("01/02/2026 11:00:00.5"))
    assert ingest(spark, store, str(folder)).files == {"plain_2026_02_01.csv": "changed"}


@pytest.mark.parametrize("block", [1 << 26, 300])
def test_the_order_of_lines_counts(spark, folder, store, monkeypatch, block):
    """The same lines in another order are other content, also in files of several blocks."""
    monkeypatch.setattr(files, "BLOCK_BYTES", block)
    fill = [line(f"01/02/2026 10:00:{i:02d}.5", label=f"n{i}") for i in range(20)]
    path = export(folder, "a_2026_02_01.csv", *fill, line("01/02/2026 11:00:00.5", label='"p\na\nb\nr"'))
    ingest(spark, store, str(folder))
    export(folder, "a_2026_02_01.csv", *fill, line("01/02/2026 11:00:00.5", label='"p\nb\na\nr"'))
    assert ingest(spark, store, str(folder), verify_all=True).files == {"a_2026_02_01.csv": "changed"}
    assert store.events().where(F.col("CP_Link_label") == "p\nb\na\nr").count() == 1


def test_a_header_of_any_length(spark, folder, store):
    names = [f"CP_{'x' * 200}{i}" for i in range(500)]
    (folder / "wide_2026_02_01.csv").write_text(
        ",".join(["timestamp", "user_id", "session_id", "name", *names])
        + "\n"
        + ",".join(["01/02/2026 10:00:00", "u", "s", "n", *map(str, range(500))])
        + "\n"
    )
    ingest(spark, store, str(folder))
    row = store.events().first()
    assert len(row) == 504 and row[names[-1]] == "499"


def test_columns_of_times_are_found(spark, folder, store):
    header = "timestamp,user_id,session_id,name,CP_Seen,CP_Mixed,CP_None"
    export(folder, "a_2026_02_01.csv", "01/02/2026 10:00:00,u,s,n,02/02/2026,02/02/2026,",
           "01/02/2026 10:00:01,u,s,n,2026-02-03 01:02:03,later,", header=header)
    ingest(spark, store, str(folder))
    kinds = dict(store.events().dtypes)
    assert [kinds[c] for c in ("timestamp", "CP_Seen", "CP_Mixed", "CP_None")] == [
        "timestamp", "timestamp", "string", "string",
    ]
    # A later text in a column of times makes it a text, also for the rows stored before; nothing is lost.
    export(folder, "b_2026_02_02.csv", "02/02/2026 10:00:00,u,s,n,soon,03/02/2026,2026-01-01", header=header)
    done = ingest(spark, store, str(folder))
    assert done.without_time == 0 and done.widened == ["CP_Seen"]
    assert {r.CP_Seen for r in store.events().collect()} == {"02/02/2026", "2026-02-03 01:02:03", "soon"}
    # It stays one, and what was empty so far gets the kind of its first values.
    export(folder, "c_2026_02_03.csv", "03/02/2026 10:00:00,u,s,n,04/02/2026,x,2026-01-02 10:00", header=header)
    assert ingest(spark, store, str(folder)).widened == []
    assert dict(store.events().dtypes) == kinds | {"CP_Seen": "string", "CP_None": "timestamp"}
    report = {r.name: (r.kind, r.filled, r.times, r.unusable) for r in store.column_report().collect()}
    assert report["CP_Seen"] == ("text", 4, 2, 0)
    assert report["CP_None"] == ("time", 2, 2, 0)


def test_declared_times(spark, folder, store):
    """A declared column reads as times; what is none is counted and kept as text in the store."""
    header = "timestamp,user_id,session_id,name,CP_Due"
    export(folder, "a_2026_02_01.csv", "01/02/2026 10:00:00,u,s,n,02/02/2026", "nonsense,u,s,n,soon", header=header)
    done = ingest(spark, store, str(folder), date_columns=["cp_due"])
    assert done.without_time == 1
    assert rows(store.events().select(F.col("CP_Due").cast("string"))) == [("2026-02-02 00:00:00",), (None,)]
    assert rows(store.stored().select("CP_Due", "__timestamp_text")) == [("02/02/2026", None), ("soon", "nonsense")]
    report = {r.name: (r.kind, r.unusable) for r in store.column_report().collect()}
    assert report["CP_Due"] == ("time", 1) and report["timestamp"] == ("time", 1)


def test_every_byte_counts(spark, folder, store):
    """A carriage return that becomes a line feed is a change, although length and lines look alike."""
    export(folder, "a_2026_02_01.csv", line("01/02/2026 10:00:00.5", label='"x\ry"'), mtime=1_700_000_000)
    ingest(spark, store, str(folder))
    assert store.events().first().CP_Link_label in ("x\ry", "x\ny")
    export(folder, "a_2026_02_01.csv", line("01/02/2026 10:00:00.5", label='"x\ny"'), mtime=1_700_000_001)
    assert ingest(spark, store, str(folder)).files == {"a_2026_02_01.csv": "changed"}
    assert store.events().first().CP_Link_label == "x\ny"
    # The same length and change time are taken for the same file, unless all files are to be verified.
    export(folder, "a_2026_02_01.csv", line("01/02/2026 10:00:00.5", label='"x\nz"'), mtime=1_700_000_001)
    assert ingest(spark, store, str(folder)) is None
    assert ingest(spark, store, str(folder), verify_all=True).files == {"a_2026_02_01.csv": "changed"}


def test_a_file_changed_while_it_was_recorded_is_looked_at_again(spark, folder, store):
    export(folder, "a_2026_02_01.csv", line("01/02/2026 10:00:00.5", label="x"), mtime=4_000_000_000)
    ingest(spark, store, str(folder))
    export(folder, "a_2026_02_01.csv", line("01/02/2026 10:00:00.5", label="y"), mtime=4_000_000_000)
    assert ingest(spark, store, str(folder)).files == {"a_2026_02_01.csv": "changed"}


def test_headers_over_several_lines(spark, folder, store):
    header = 'timestamp,user_id,session_id,name,"two\nlines",z'
    export(folder, "a_2026_02_01.csv", "01/02/2026 10:00:00,u,s,n,one,last", header=header)
    ingest(spark, store, str(folder))
    assert store.events().columns[-2:] == ["two\nlines", "z"]
    assert tuple(store.events().first())[-2:] == ("one", "last")


def test_more_fields_than_the_header(spark, folder, store):
    export(folder, "a_2026_02_01.csv", line("01/02/2026 10:00:00.5") + ",beyond")
    with pytest.raises(ValueError, match="more fields"):
        ingest(spark, store, str(folder))
    assert store.current().number == 0


def test_known_files_are_not_opened_again(spark, folder, store, monkeypatch):
    export(folder, "a_2026_02_01.csv", line("01/02/2026 10:00:00.5"), mtime=1_700_000_000)
    ingest(spark, store, str(folder))

    def opened(*_):
        raise AssertionError("a file was read")

    monkeypatch.setattr(files, "fingerprints", opened)
    assert ingest(spark, store, str(folder)) is None


def test_missing_files(spark, folder, store):
    with pytest.raises(FileNotFoundError):
        ingest(spark, store, str(folder))


def test_upsert_rules(spark):
    schema = "timestamp string, user_id string, session_id string, name string, v string"
    target = spark.createDataFrame(
        [("t1", "u", "s", "n", "old"), ("t2", "u", None, "n", "old"), ("t3", "u", "s", "n", "old")],
        schema,
    )
    batch = spark.createDataFrame(
        [
            ("t1", "u", "s", "n", "b1", 0),
            ("t1", "u", "s", "n", "b1 copy", 0),
            ("t2", "u", None, "n", "b1", 0),
            ("t4", "u", "s", "n", "b1", 0),
            ("t4", "u", "s", "n", "b2", 1),
            ("t2", "u", None, "n", "b2", 1),
        ],
        schema + ", rank int",
    )
    got = [(r.timestamp, r.v) for r in upsert(target, batch, rank="rank").collect()]
    assert sorted(got) == [
        ("t1", "b1"),
        ("t1", "b1 copy"),  # duplicates inside one delivery stay
        ("t2", "b1"),
        ("t2", "b2"),
        ("t2", "old"),  # a key with a NULL part never matches
        ("t3", "old"),
        ("t4", "b2"),
    ]
    assert sorted(r.v for r in upsert(None, batch, rank="rank").collect()) == sorted(
        ["b1", "b1 copy", "b1", "b2", "b2"]
    )
