"""Star schema rules and the whole job from export files to published tables."""

from __future__ import annotations

import tempfile
from dataclasses import fields
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clickloom import job
from oracle import bindings
from clickloom.operators.numbering import with_dense_key
from clickloom.plans import enrich, pipeline, star
from clickloom.sources.store import EventStore
from conftest import SMALL, rows

PEPPER = "test-pepper"


@pytest.fixture(scope="module")
def events(spark):
    return enrich.enrich(bindings.click_events(spark, SMALL), bindings.hr(spark, SMALL)).cache()


def test_dense_keys_follow_the_order(spark):
    df = spark.range(1000).select((F.hash("id") % 5000).alias("a"), "id").distinct()
    keyed = with_dense_key(df, ["a", "id"], "key").orderBy("a", "id").collect()
    assert [r.key for r in keyed] == list(range(1, 1001))
    assert with_dense_key(df.limit(0), ["a", "id"], "key").count() == 0


def test_fact_rows_and_keys(spark, events):
    dims = star.dimensions(events)
    fact = star.fact_event(events, dims, PEPPER)
    keys = ["date_key", "org_key", "site_key", "page_key", "link_type_key", "component_key"]
    assert fact.columns[:7] == [*keys, "person_hash"] and len(fact.columns) == 25
    assert fact.count() == events.count()
    assert fact.where(" or ".join(f"{k} is null" for k in keys)).count() == 0
    assert not {"gpn", "email", "CP_GPN", "CP_Email"} & set(fact.columns)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_org_dimension_does_not_fan_out(spark, events):
    blank = events.withColumn(
        "hr_division",
        F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 3 == 1, None).otherwise("a|b"),
    ).withColumn("hr_job_title", F.when(F.col("event_id") % 2 == 0, "c"))
    dim = star.dim_organization(blank)
    assert dim.count() == 4
    dims = star.Star(star.dim_date(blank), dim, *[f(blank) for f in (
        star.dim_site, star.dim_page, star.dim_link_type, star.dim_component)])
    assert star.fact_event(blank, dims, PEPPER).count() == events.count()


def test_without_organisation_there_is_one_row(spark, events):
    plain = events.drop("hr_division", "hr_job_title")
    dims = star.dimensions(plain)
    assert [(r.org_key, r.org_hash) for r in dims.dim_organization.collect()] == [(1, "")]
    assert star.fact_event(plain, dims, PEPPER).where("org_key = 1").count() == plain.count()


def test_organisation_history(spark):
    """Periods of equal organisation, without gap or overlap, agree with the as-of join in every month."""
    schema = "gpn string, snapshot_year int, snapshot_month int, gcrs_division_desc string, job_title string"
    months = [(2023, m) for m in (2, 3, 4, 7, 8, 11)]
    values = {"1": "aabbba", "2": ".aab.b", "3": "aaaaaa", "4": "...a..", "5": "......"}
    data = [(g, y, m, None if v == "." else v, "job") for g, vs in values.items() for (y, m), v in zip(months, vs)]
    data += [("1", 2023, 2, "A", "other of the month"), (None, 2023, 2, "x", "x"), ("6", None, 2, "x", "x")]
    hr = spark.createDataFrame(data, schema)
    history = star.organization_history(hr)
    found = rows(history.select("gpn", F.col("valid_from").cast("string"), F.col("valid_to").cast("string"), "division"))
    assert [r for r in found if r[0] == "1"] == [
        ("1", "2023-04-01", "2023-10-31", "b"), ("1", "2023-11-01", None, "a"), ("1", None, "2023-03-31", "a"),
    ]
    assert [r for r in found if r[0] in "35"] == [("3", None, None, "a"), ("5", None, None, None)]
    days = [f"{y}-{m:02d}-{d} 12:00:00" for y in (2022, 2023, 2024) for m in range(1, 13) for d in ("01", "28")]
    events = spark.createDataFrame([(g, t) for g in [*values, "9"] for t in days], "gpn string, t string")
    events = events.select("gpn", F.col("t").cast("timestamp").alias("timestamp"))
    asof = enrich.with_organisation(events, hr).select("gpn", "timestamp", "hr_division", "hr_job_title")
    versioned = star.with_org_version(events, history)
    told = versioned.join(history.drop("gpn"), "org_version_key", "left")
    assert rows(told.select("gpn", "timestamp", "division", "job_title")) == rows(asof)
    assert [r.org_version_key for r in history.orderBy("org_version_key").collect()] == list(range(1, history.count() + 1))
    assert star.organization_history(hr.limit(0)).count() == 0


def test_numeric_ids_with_nulls(spark, events):
    numeric = events.withColumn("CP_SiteID", F.when(F.col("event_id") > 10, F.col("event_id") % 4))
    assert star.dim_site(numeric).where("site_id = ''").count() > 0


def test_whole_job(spark):
    root = Path(tempfile.mkdtemp(prefix="run-"))
    (root / "input").mkdir()
    ts = F.concat(F.date_format("timestamp", "dd/MM/yyyy HH:mm:ss.SSSSSS"), F.lit("7"))
    source_rows = bindings.click_events(spark, SMALL)
    text = source_rows.select(ts.alias("timestamp [UTC]"), *[c for c in source_rows.columns if c != "timestamp"])
    text = text.withColumnsRenamed({"user_id": "user_Id", "session_id": "session_Id"})
    pdf = text.toPandas()
    pdf.iloc[:600].to_csv(root / "input" / "export_2024_01_01.csv", index=False)
    pdf.iloc[400:].to_csv(root / "input" / "export_2024_02_01.csv", index=False)
    bindings.hr(spark, SMALL).write.parquet(str(root / "hr"))
    args = (spark, str(root / "input"), str(root / "store"), str(root / "out"), PEPPER, str(root / "hr"))

    done = pipeline.run(*args)
    assert done.ingested.row_counts == {"export_2024_01_01.csv": 600, "export_2024_02_01.csv": 600}
    assert sorted(done.tables) == sorted(
        ["events_raw", "events_anonymized", "video_engagement", "video_engagement_anonymized"]
        + [f"cdm/{t}" for t in (
            "dim_date", "dim_organization", "dim_site", "dim_page", "dim_link_type",
            "dim_component", "dim_organization_history", "fact_event")]
    )
    tables = {name: spark.read.parquet(path) for name, path in done.tables.items() if name != "cdm/fact_event"}
    tables["cdm/fact_event"] = pipeline.read_fact(spark, str(root / "out"))
    assert tables["events_raw"].count() == tables["cdm/fact_event"].count() == 1000
    # an empty CSV field is a missing value
    loaded = source_rows.withColumn("CP_GPN", F.nullif("CP_GPN", F.lit("")))
    expected = enrich.enrich(loaded, bindings.hr(spark, SMALL))
    wanted = ["event_id", "session_key", "event_order", "ms_since_prev_event", "hr_division", "gpn"]
    as_text = [F.col(c).cast("string") for c in wanted]
    assert rows(tables["events_raw"].select(as_text)) == rows(expected.select(as_text))
    for name in ("events_anonymized", "video_engagement_anonymized", "cdm/fact_event"):
        names = {c.lower() for c in tables[name].columns}
        assert not names & {"gpn", "cp_gpn", "email", "cp_email"} and "person_hash" in names
    for report in done.reports.values():
        assert report.count() > 0

    assert pipeline.run(*args) is None
    again = pipeline.run(*args, mode="full_refresh")
    assert spark.read.parquet(again.tables["events_raw"]).count() == 1000


@pytest.fixture
def root():
    folder = Path(tempfile.mkdtemp(prefix="run-"))
    (folder / "in").mkdir()
    (folder / "in" / "c_2024_01_01.csv").write_text(
        "timestamp [UTC],name,user_Id,session_Id\n01/01/2024 10:00,click_event,u,s\n"
    )
    return folder


def test_publishing_is_made_up_for(spark, root, monkeypatch):
    args = (spark, str(root / "in"), str(root / "st"), str(root / "out"), PEPPER)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(pipeline, "publish", dies)
        with pytest.raises(RuntimeError):
            pipeline.run(*args)
    done = pipeline.run(*args)
    assert done.ingested is None and "cdm/fact_event" in done.tables
    assert pipeline.run(*args) is None


def test_delta_run_rebuilds_only_touched_dates(spark, root):
    """After each delivery the published tables equal those of a full rebuild."""
    header = "timestamp [UTC],name,user_Id,session_Id,CP_GPN"
    hr = spark.createDataFrame(
        [("00000001", 2024, 1, "d")],
        "gpn string, snapshot_year int, snapshot_month int, gcrs_division_desc string",
    )
    hr.write.parquet(str(root / "hr"))
    args = (spark, str(root / "in"), str(root / "st"), str(root / "out"), PEPPER, str(root / "hr"))
    store = EventStore(spark, str(root / "st"))

    def deliver(name, *lines, columns=header):
        (root / "in" / name).write_text("\n".join([columns, *lines]) + "\n")
        return pipeline.run(*args)

    def agrees_with_full_rebuild():
        full = enrich.enrich(store.events(), spark.read.parquet(str(root / "hr")))
        shown = spark.read.schema(full.schema).parquet(str(root / "out" / "events_raw"))
        text = [F.col(c).cast("string") for c in full.columns]
        assert rows(shown.select(text)) == rows(full.select(text))
        safe = spark.read.parquet(str(root / "out" / "events_anonymized"))
        assert safe.count() == full.count()
        out = str(root / "out")
        dims = star.Star(**{f.name: spark.read.parquet(f"{out}/cdm/{f.name}") for f in fields(star.Star)})
        fact = pipeline.read_fact(spark, out)
        history = star.organization_history(spark.read.parquet(str(root / "hr")))
        expected = star.fact_event(star.with_org_version(full, history), dims, PEPPER, ["org_version_key"])
        assert rows(fact.select(*expected.columns)) == rows(expected)

    def written_at(day):
        folder = root / "out" / "events_raw" / f"session_date={day}"
        return {f.name for f in folder.glob("*.parquet")}

    deliver("c_2024_05_01.csv", "01/05/2024 21:59:59,a,u,s,1", "01/05/2024 22:00:01,b,u,s,1")
    before = written_at("2024-05-02")
    agrees_with_full_rebuild()
    # an earlier event of an existing session, one after local midnight, one without time
    deliver("c_2024_05_03.csv", "03/05/2024 21:00:00,c,u,s,1", "03/05/2024 22:30:00,d,u,s,1", "soon,e,u,s,1")
    assert written_at("2024-05-02") == before
    agrees_with_full_rebuild()
    deliver("c_2024_05_04.csv", "03/05/2024 20:00:00,f,u,s,1,t", columns=header + ",CP_Topic")
    assert written_at("2024-05-02") == before
    agrees_with_full_rebuild()
    deliver("c_2024_05_05.csv", "01/05/2024 22:00:00,g,u,s,1")
    assert written_at("2024-05-02") != before
    agrees_with_full_rebuild()
    # changed snapshots affect events of any day
    hr.withColumn("gcrs_division_desc", F.lit("new")).write.mode("overwrite").parquet(str(root / "hr"))
    assert pipeline.run(*args).ingested is None
    agrees_with_full_rebuild()
    assert pipeline.run(*args) is None


def test_command_line(spark, root):
    (root / "key").write_text("secret\n")
    options = ["--input", root / "in", "--store", root / "st", "--output", root / "out"]
    options = [str(o) for o in [*options, "--pepper-file", root / "key"]]
    assert job.main(options) == 0
    assert job.main(options) == 0
    assert job.main([*options, "--file", str(root / "in" / "c_2024_01_01.csv")]) == 0
    assert pipeline.read_fact(spark, str(root / "out")).count() == 1
    assert spark.read.parquet(str(root / "out" / "reports" / "columns")).count() == 4
    assert job.main([*options, "--verify-all", "--date-column", "CP_Due", "--count-first-event"]) == 0


def test_job_without_hr_table(spark, root):
    done = pipeline.run(spark, str(root / "in"), str(root / "st"), str(root / "out"), PEPPER, str(root / "no"))
    assert "video_engagement" not in done.tables
    fact = pipeline.read_fact(spark, str(root / "out")).first()
    assert (fact.org_key, fact.person_hash, fact.session_key) == (1, None, "2024-01-01_u_s")
