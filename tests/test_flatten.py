"""Raw log rows: parsing guards, key discovery, filters, reports."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clickloom.operators import flatten as flat
from clickloom.operators.shares import smallest_values
from clickloom.plans import explore, profile
from clickloom.plans.anonymize import anonymize
from clickloom.schema import spellings_in
from conftest import rows

NOW = datetime(2024, 6, 1)


def log(spark, *props, name="click_event"):
    """``props``: a dict (encoded twice), or the text of the whole details column."""
    data = [
        (
            NOW,
            name,
            "DE",
            f"u{i}",
            "s",
            json.dumps({"CustomProps": json.dumps(p)}) if isinstance(p, dict) else p,
        )
        for i, p in enumerate(props)
    ]
    return spark.createDataFrame(
        data,
        "timestamp timestamp, name string, client_CountryOrRegion string, user_Id string, "
        "session_Id string, customDimensions string",
    )


CASES = (
    {"GPN": "1", "Topic": None, "Nested": {"a": [1, 2]}, 'quo"te': "x"},
    {},
    None,
    "",
    "no json",
    '{"Other": 1}',
    '{"CustomProps": "no json"}',
    '{"CustomProps": "{broken"}',
    '{"CustomProps": "[1]"}',
    '{"CustomProps": ""}',
    '{"CustomProps": "[{\\"GPN\\": \\"1\\"}]"}',
)


def test_bag_guards(spark):
    bags = log(spark, *CASES).select("user_Id", flat.property_bag().alias("bag")).collect()
    assert bags[0].bag == {"GPN": "1", "Topic": "", "Nested": '{"a":[1,2]}', 'quo"te': "x"}
    assert all(r.bag == {} for r in bags[1:])


def test_flatten_keeps_every_row(spark):
    got = flat.flatten(log(spark, *CASES), ["GPN", "Topic", "Email"])
    assert got.columns[5:] == ["CP_GPN", "CP_Topic", "CP_Email"]
    values = [tuple(r)[5:] for r in got.collect()]
    assert values == [("1", "", None)] + [(None, None, None)] * (len(CASES) - 1)


def test_key_discovery(spark):
    assert explore.distinct_people(log(spark, *CASES), "p").first().exact_gpn == "2"
    df = log(spark, *CASES, {"GPN": "2"}, {"GPN": "1"})
    assert rows(flat.key_inventory(df).where("key = 'GPN'")) == [("GPN", 3, 2, "1")]
    assert flat.discovered_keys(df) == sorted(["GPN", "Topic", "Nested", 'quo"te'])
    every = flat.flatten(df, prefix="")
    assert every.columns[5:] == flat.discovered_keys(df)
    assert {r['quo"te'] for r in every.collect()} == {"x", None}


def test_keys_that_differ_in_case(spark):
    df = log(spark, {"GPN": "1", "gpn": "2", "Email": "a@x", "email": "b@x"}, {"gpn": None}, {"GPN": "3"})
    got = flat.flatten(df)
    assert got.columns[5:] == ["CP_Email", "CP_GPN", "CP_email_1", "CP_gpn_1"]
    assert [tuple(r)[5:] for r in got.collect()] == [("a@x", "1", "b@x", "2"), (None, None, None, ""), (None, "3", None, None)]
    hidden = flat.pseudonymous_flat(df, "p")
    assert hidden.columns[5:] == ["CP_GPN", "CP_gpn_1"]
    assert not {"1", "2", "3"} & {v for r in hidden.collect() for v in tuple(r)[5:]}
    safe = anonymize(got, "p")
    assert safe.columns[5:] == ["CP_Person_Hash", "CP_Person_Hash_1"]
    assert spellings_in(got.columns, "gpn") == ["CP_GPN", "CP_gpn_1"]
    assert flat.flatten(flat.with_email_containing(df, "A@X")).count() == 1


def test_values_of_every_kind(spark):
    text = '{"n": 1.50, "t": true, "o": {"a": [1, null]}, "s": "x", "d": 1, "d": 2, "a.b": "dot", "z": null}'
    row = flat.flatten(log(spark, json.dumps({"CustomProps": text}), {})).orderBy("user_Id").collect()
    got = {k: v for k, v in row[0].asDict().items() if k.startswith("CP_")}
    assert got == {
        "CP_n": "1.5", "CP_t": "true", "CP_o": '{"a":[1,null]}', "CP_s": "x", "CP_d": "2", "CP_a.b": "dot", "CP_z": "",
    }
    assert set(tuple(row[1])[5:]) == {None}


def test_many_keys_all_become_columns(spark):
    df = log(spark, {f"key{i}": str(i) for i in range(2500)})
    got = flat.flatten(df).first()
    assert len(got) == 5 + 2500 and got["CP_key2499"] == "2499"


def test_pseudonymous_flat_in_any_spelling(spark):
    got = flat.pseudonymous_flat(log(spark, {"gpn": "1", "EMAIL": "a@b", "Topic": "t"}), "p", prefix="")
    assert got.columns[5:] == ["Topic", "gpn"]
    assert len(got.first()["gpn"]) == 64


def test_export_text_and_order(spark):
    df = log(spark, {"GPN": "1"}).withColumn("timestamp", F.lit(datetime(2024, 12, 1, 2, 3, 4, 56)))
    both = log(spark, {"GPN": "2"}).unionByName(df)
    got = flat.export_view(flat.flatten(both, ["GPN"]), newest_first=True).collect()
    assert [r["timestamp [UTC]"] for r in got] == [
        "01/12/2024 02:03:04.0000560",
        "01/06/2024 00:00:00.0000000",
    ]


def test_time_and_name_filter_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    log(spark, *CASES).write.parquet(path)
    recent = flat.recent(spark.read.parquet(path), datetime(2024, 6, 2), 90)
    assert recent.count() == len(CASES)
    plan = explore.daily_trend(recent)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan and "EqualTo(name,click_event)" in plan
    assert "ReadSchema: struct<timestamp:timestamp,name:string>" in plan
    assert flat.recent(spark.read.parquet(path), datetime(2024, 9, 2), 90).count() == 0


def test_email_filter_ignores_case(spark):
    df = log(spark, {"Email": "John.Doe@x"}, {"Email": "jane@x"}, {"Email": None}, *CASES)
    assert flat.with_email_containing(df, "john.doe").count() == 1


def test_pseudonymous_flat_has_no_person_data(spark):
    got = flat.pseudonymous_flat(log(spark, {"GPN": "1", "Email": "a@x"}), "pepper")
    assert "CP_Email" not in got.columns
    assert len(got.first().CP_GPN) == 64


def test_samples_are_the_smallest_values(spark):
    df = spark.createDataFrame(
        [("hot", f"v{i:03d}") for i in range(300)] * 2 + [("b", None), ("b", "x")], "g string, v string"
    )
    got = {r.g: r.s for r in smallest_values(df, ["g"], "v", "s", 3).collect()}
    assert got == {"hot": ["v000", "v001", "v002"], "b": ["x"]}
    plan = smallest_values(df, ["g"], "v", "s", 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle


def test_field_profile_of_nothing(spark):
    got = explore.field_profile(log(spark, {}).where("false")).first()
    counts = [c for c in got.asDict() if not c.endswith("_values")]
    assert {got[c] for c in counts} == {0}


def test_raw_sample_keeps_the_bag(spark):
    got = explore.raw_sample(log(spark, *CASES), 20)
    assert got.count() == len(CASES)
    assert got.where(F.size("properties") > 0).count() == 1


def test_shares_and_coverage_of_nothing(spark):
    schema = "name string, gpn string, hr_division string, CP_Link_Type string"
    empty = spark.createDataFrame([], schema)
    assert profile.event_types(empty).count() == 0
    row = profile.hr_coverage(empty).first()
    assert (row.total, row.gpn_pct, row.hr_pct) == (0, 0.0, 0.0)
    assert {r.pct for r in profile.field_coverage(empty).collect()} == {0.0}


def test_keys_that_differ_in_case_take_no_map_of_the_document(spark):
    documents = ['{"GPN": null, "a": 1}', '{"gpn": "2", "GPN": "1", "gPN": "3"}', '{"Gpn": {"x": 1}}', '{"a": null}']
    wrapped = [(json.dumps({"CustomProps": d}),) for d in documents]
    log = spark.createDataFrame(wrapped, f"{flat.DETAILS} string")
    log = log.withColumns({c: F.lit(None).cast("string") for c in flat.LOG_COLUMNS})
    found = flat.flatten(log)
    assert "map<string" not in found._jdf.queryExecution().optimizedPlan().toString()
    told = [tuple(r[c] for c in ("CP_GPN", "CP_Gpn_1", "CP_gPN_2", "CP_gpn_3", "CP_a")) for r in found.collect()]
    assert told == [("", None, None, None, "1"), ("1", None, "3", "2", None), (None, '{"x":1}', None, None, None), (None, None, None, None, "")]
