"""The given events as dated export files, delivered twice: one file changes, one is new, one stays as it was."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.plans.ingest import Ingested, ingest
from clickloom.session import scratch_dir
from clickloom.sources.store import EventStore
from oracle import bindings

#: Each delivery is written as so many files by so many tasks.
PARTS = 4
DATES = {"a": "2024_01_31", "b": "2024_02_29", "c": "2024_03_31"}
FILES = {f"{name}{part}": f"export_{part}_{date}.csv" for name, date in DATES.items() for part in range(PARTS)}


def _exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Person numbers keep their zeros; one column of days and one of times go with every row."""
    return bindings.click_events(spark, sf_dir).select(
        F.date_format("timestamp", "dd/MM/yyyy HH:mm:ss.SSSSSS").alias("timestamp [UTC]"),
        "name",
        "client_CountryOrRegion",
        F.col("user_id").alias("user_Id"),
        F.col("session_id").alias("session_Id"),
        "event_id",
        F.lpad(F.col("CP_GPN"), 8, "0").alias("CP_GPN"),
        F.date_format("timestamp", "dd.MM.yyyy").alias("CP_Due"),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("CP_Seen"),
        "CP_Link_label",
    )


def _dealt(df: DataFrame) -> DataFrame:
    """Rows with the number of their file, every file's in a task of its own; hashes of the numbers would meet in one.

    Ranges are drawn finer than the files, as no number is ever cut but two may share a coarse range.
    """
    numbered = df.withColumn("part", (F.floor(F.col("event_id") / 30) % PARTS).cast("int"))
    return numbered.repartitionByRange(8 * PARTS, "part")


def _put(df: DataFrame, folder: str, delivery: str) -> None:
    """The CSV files of a delivery, in place of older ones."""
    spark = df.sparkSession
    written = f"{folder}/_{uuid.uuid4().hex}"
    _dealt(df).write.partitionBy("part").option("header", True).option("escape", chr(34)).csv(written)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for part in range(PARTS):
        if fs.exists(path(f"{written}/part={part}")):
            files = [s.getPath() for s in fs.listStatus(path(f"{written}/part={part}"))]
            (found,) = [f for f in files if f.getName().startswith("part-")]
            target = path(f"{folder}/{FILES[f'{delivery}{part}']}")
            fs.delete(target, False)
            fs.rename(found, target)
    fs.delete(path(written), True)


def deliver(spark: SparkSession, sf_dir: str) -> tuple[EventStore, Ingested, Ingested]:
    """Two runs. In the second one the files of b change, those of c are new, and their days are partly no days."""
    root = f"{scratch_dir(spark).rstrip('/')}/deliveries-{uuid.uuid4().hex}"
    folder, store = f"{root}/input", EventStore(spark, f"{root}/store")
    rows = _exported(spark, sf_dir)
    third = F.col("event_id") % 3
    _put(rows.where(third == 0), folder, "a")
    _put(rows.where(third == 1), folder, "b")
    first = ingest(spark, store, folder)
    changed = rows.where((third == 1) & (F.col("event_id") % 30 != 1))
    _put(changed.withColumn("CP_Link_label", F.lit('second, "edition"')), folder, "b")
    late = rows.where(F.col("event_id") % 6 == 0).withColumn("CP_Link_label", F.lit("late"))
    due = F.when(F.col("event_id") % 5 == 0, "Budget 2024").otherwise(F.col("CP_Due"))
    # This delivery spells two headers differently.
    spelled = {"CP_GPN": "CP_gpn", "CP_Due": "CP_due"}
    _put(rows.where(third == 2).unionByName(late).withColumn("CP_Due", due).withColumnsRenamed(spelled), folder, "c")
    return store, first, ingest(spark, store, folder)


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _, _ = deliver(spark, sf_dir)
    return store.events().select(
        "timestamp",
        "user_id",
        "session_id",
        "name",
        F.col("event_id").cast("long").alias("event_id"),
        F.col("CP_Link_label").alias("label"),
        F.col("CP_GPN").alias("gpn"),
        F.col("CP_Due").alias("due"),
        F.col("CP_Seen").alias("seen"),
    )


def column_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every column is after the two runs, and how many of its values were delivered, were times, cannot be shown."""
    store, _, second = deliver(spark, sf_dir)
    report = store.column_report()
    return report.withColumn("widened", F.col("name").isin(second.widened))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every known file with its rows, and why each of the two runs loaded it."""
    store, first, second = deliver(spark, sf_dir)
    seen = {name: (first.files.get(name, "skipped"), second.files.get(name, "skipped")) for name in FILES.values()}
    reasons = spark.createDataFrame(
        [(name, *why) for name, why in seen.items()], "filename string, first_run string, second_run string"
    )
    known = store.processed_report().select("filename", F.col("row_count").cast("long").alias("row_count"), "date_suffix")
    return known.join(reasons, "filename")


_SAME = "{0}.t = {1}.t and {0}.user_id = {1}.user_id and {0}.session_id = {1}.session_id and {0}.name = {1}.name"


def _unless(rows: str, *later: str) -> str:
    beaten = " or ".join(f"exists (select 1 from {x} where {_SAME.format(rows, x)})" for x in later)
    return f"select * from {rows} where not ({beaten})"


STORED = f"""
, exported as (
  select "timestamp" as t, user_id, session_id, name, event_id, nullif(CP_Link_label, '') as label,
    lpad(CP_GPN, 8, '0') as gpn, strftime("timestamp", '%d.%m.%Y') as due, date_trunc('second', "timestamp") as seen,
    event_id // 30 % {PARTS} as part
  from click_rows),
file_a as (select * from exported where event_id % 3 = 0),
file_b as (select * from exported where event_id % 3 = 1),
next_b as (select * replace ('second, "edition"' as label) from file_b where event_id % 30 <> 1),
file_c as (
  select * replace (if(event_id % 5 = 0, 'Budget 2024', due) as due) from (
    select * from exported where event_id % 3 = 2
    union all select * replace ('late' as label) from exported where event_id % 6 = 0)),
stored as (
  {_unless("file_a", "file_b", "next_b", "file_c")} union all {_unless("file_b", "next_b", "file_c")}
  union all {_unless("next_b", "file_c")} union all select * from file_c)"""
