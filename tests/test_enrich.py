"""Derived columns: person numbers, local time, as-of fields, order and gaps; hash functions."""

from __future__ import annotations

import hashlib
import hmac
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from oracle import bindings
from clickloom.functions import hmac_sha256, link_host, normalize_gpn, parse_export_time, thousands
from clickloom.operators.ordered import HotGroups
from clickloom.plans import anonymize, enrich
from clickloom.schema import resolve, spellings_in
from conftest import SMALL, rows

RAW = "timestamp timestamp, name string, user_id string, session_id string, CP_GPN string"


def column(spark, values, data_type="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {data_type}")


def apply(spark, values, fn, data_type="string"):
    df = column(spark, values, data_type).select("i", fn(F.col("x")).alias("y")).orderBy("i")
    return [r.y for r in df.collect()]


def test_gpn_forms(spark):
    given = ["1234", "00001234", "1234.0", "1234567890", "", None, "12.05"]
    assert apply(spark, given, normalize_gpn) == [
        "00001234", "00001234", "00001234", "12345678", "00000000", None, "00012.05",
    ]


def test_gpn_takes_first_filled_spelling(spark):
    df = spark.createDataFrame([(None, "7"), ("5", "7")], "CP_gpn string, GPN string")
    got = df.withColumns(enrich.person_columns(df)).select("gpn").collect()
    assert [r.gpn for r in got] == ["00000007", "00000005"]


def test_spellings():
    assert resolve(["cp_siteid", "x"], "site_id") == "cp_siteid"
    assert spellings_in(["gpn", "CP_gpn"], "gpn") == ["CP_gpn", "gpn"]
    assert resolve(["x"], "page_url") is None


def test_time_spellings(spark):
    full = datetime(2026, 2, 25, 13, 14, 15, 123456)
    given = {
        "25/02/2026 13:14:15.1234567": full,
        "25/02/2026 13:14:15.123456": full,
        "25/02/2026 13:14:15.123": full.replace(microsecond=123000),
        "25/02/2026 13:14:15": full.replace(microsecond=0),
        "25/02/2026 13:14": datetime(2026, 2, 25, 13, 14),
        "25/02/2026": datetime(2026, 2, 25),
        "25.02.2026 13:14:15": full.replace(microsecond=0),
        "25.02.2026 13:14": datetime(2026, 2, 25, 13, 14),
        "25.02.2026": datetime(2026, 2, 25),
        "2026-02-25 13:14:15.123456": full,
        "2026-02-25 13:14:15": full.replace(microsecond=0),
        "2026-02-25T13:14:15.123Z": full.replace(microsecond=123000),
        "2026-02-25T13:14:15+01:00": full.replace(hour=12, microsecond=0),
        "31/02/2026": None,
        "2026": None,
        "soon": None,
        "": None,
    }
    assert apply(spark, list(given), parse_export_time) == list(given.values())


def test_thousands_and_hosts(spark):
    numbers = [0, 999, 1000, 1234567, 1000000000]
    assert apply(spark, numbers, thousands, "long") == [
        "0", "999", "1'000", "1'234'567", "1'000'000'000",
    ]
    urls = ["https://a.example.com/x?y", "http://b", "/relative", ""]
    assert apply(spark, urls, link_host) == ["a.example.com", "b", "", ""]


@pytest.mark.parametrize("key", ["k", "x" * 64, "long key " * 20, "schlüssel"])
def test_hmac_equals_the_standard_library(spark, key):
    values = ["00001234", "grüße", "00000000"]
    expected = [hmac.new(key.encode(), v.encode(), hashlib.sha256).hexdigest() for v in values]
    assert apply(spark, values, lambda c: hmac_sha256(c, key)) == expected
    assert apply(spark, [None, "", "  "], lambda c: hmac_sha256(c, key)) == [None] * 3


def raw(spark, *events):
    return spark.createDataFrame(events, RAW)


def test_local_time_across_daylight_saving(spark):
    df = raw(
        spark,
        (datetime(2024, 3, 31, 0, 59, 59), "n", "u", "s", "1"),
        (datetime(2024, 3, 31, 1, 0, 0), "n", "u", "s", "1"),
        (datetime(2024, 6, 30, 22, 30), "n", "u", None, "1"),
        (datetime(2024, 10, 27, 1, 0), "n", None, "s", "1"),
    )
    got = enrich.with_session_columns(df).orderBy("timestamp").collect()
    assert [r.event_hour for r in got] == [1, 3, 0, 2]
    assert got[2].session_date == date(2024, 7, 1) and got[2].session_key == "2024-07-01_u_"
    assert got[3].session_key == "2024-10-27__s"
    assert (got[2].event_weekday, got[2].event_weekday_num) == ("Monday", 1)
    assert got[0].timestamp_cet_str == "2024-03-31 01:59:59.000"


def test_order_and_gaps(spark):
    t = datetime(2024, 1, 1, 10, 0, 0)
    df = raw(
        spark,
        (t.replace(microsecond=900), "a", "u", "s", "1"),
        (t.replace(microsecond=1100), "b", "u", "s", "1"),
        (t.replace(microsecond=500900), "c", "u", "s", "1"),
        (t.replace(second=59), "d", "u", "s", "1"),
        (t.replace(minute=2), "e", "u", "s", "1"),
    )
    got = enrich.enrich(df).orderBy("timestamp").collect()
    assert [r.event_order for r in got] == [1, 2, 3, 4, 5]
    assert [r.prev_event for r in got] == [None, "a", "b", "c", "d"]
    assert [r.ms_since_prev_event for r in got] == [None, 1, 499, 58500, 61000]
    assert [r.sec_since_prev_event for r in got] == [None, 0.001, 0.499, 58.5, 61.0]
    assert [r.time_since_prev_bucket for r in got] == [
        "First Event", "< 0.5s", "< 0.5s", "30-60s", "> 60s",
    ]


HR = "gpn string, snapshot_year int, snapshot_month int, gcrs_division_desc string, job_title string"


def test_asof_cases(spark):
    hr = spark.createDataFrame(
        [
            ("00000001", 2024, 1, "old", "clerk"),
            ("00000001", 2024, 5, None, "chief"),
            ("00000001", 2024, 9, "new", "boss"),
            ("00000002", 2024, 8, "later", None),
            ("00000003", 2024, 2, "b", "x"),
            ("00000003", 2024, 2, "a", "y"),
            (None, 2024, 2, "nobody", "z"),
        ],
        HR,
    )
    df = raw(
        spark,
        (datetime(2024, 4, 30), "exact", "u", "s", "1"),
        (datetime(2024, 5, 1), "null filled", "u", "s", "1"),
        (datetime(2023, 1, 1), "before first", "u", "s", "1"),
        (datetime(2024, 12, 1), "after last", "u", "s", "1"),
        (datetime(2024, 1, 1), "later only", "u", "s", "2"),
        (datetime(2024, 3, 1), "tie", "u", "s", "3"),
        (datetime(2024, 3, 1), "unknown", "u", "s", "4"),
        (datetime(2024, 3, 1), "no number", "u", "s", None),
    )
    got = {r.name: (r.hr_division, r.hr_job_title) for r in enrich.enrich(df, hr).collect()}
    assert got == {
        "exact": ("old", "clerk"),
        "null filled": ("new", "chief"),
        "before first": ("old", "clerk"),
        "after last": ("new", "boss"),
        "later only": ("later", None),
        "tie": ("b", "x"),
        "unknown": (None, None),
        "no number": (None, None),
    }


def test_hr_numbers_padded_only_on_request(spark):
    hr = spark.createDataFrame([("1", 2024, 1, "d", "j")], HR)
    df = raw(spark, (datetime(2024, 4, 30), "n", "u", "s", "1"))
    assert enrich.enrich(df, hr).first().hr_division is None
    assert enrich.enrich(df, hr, pad_hr_gpn=True).first().hr_division == "d"


def test_blank_number_option(spark):
    df = raw(spark, (datetime(2024, 4, 30), "n", "u", "s", ""))
    assert enrich.enrich(df).first().gpn == "00000000"
    assert enrich.enrich(df, blank_gpn_is_null=True).first().gpn is None


def test_asof_keeps_rows_and_plan_has_no_nested_loop(spark):
    source_rows, hr = bindings.click_events(spark, SMALL), bindings.hr(spark, SMALL)
    joined = enrich.enrich(source_rows, hr)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    assert joined.count() == source_rows.count()


def test_hot_session_is_split_without_change(spark):
    source_rows = bindings.click_events(spark, SMALL).withColumns(
        {
            "user_id": F.when(F.col("event_id") % 3 == 0, None).otherwise(F.col("user_id")),
            "session_id": F.when(F.col("event_id") % 3 == 0, None).otherwise(F.col("session_id")),
        }
    )
    whole = enrich.enrich(source_rows, hot=None)
    split = enrich.enrich(source_rows, hot=HotGroups(15, 40, 16))
    assert rows(split.select(whole.columns)) == rows(whole)


def test_anonymize_every_spelling(spark):
    df = spark.createDataFrame(
        [("1", "a@x", "00000001", "b@x", "u")],
        "CP_gpn string, CP_email string, gpn string, Email string, user_id string",
    )
    got = anonymize.anonymize(df, "key")
    assert got.columns == ["CP_Person_Hash", "person_hash", "user_id"]
    row = got.first()
    assert row.person_hash == hmac.new(b"key", b"00000001", hashlib.sha256).hexdigest()
    assert row.CP_Person_Hash == hmac.new(b"key", b"1", hashlib.sha256).hexdigest()
