"""The files of the streamed log."""

from __future__ import annotations

from oracle import maintained


def test_streamed_files_grow_in_number(spark, monkeypatch):
    assert maintained._stream_files(spark.range(1_000)) == 4
    monkeypatch.setattr(maintained, "FILE_ROWS", 100)
    assert maintained._stream_files(spark.range(1_001)) == 12
