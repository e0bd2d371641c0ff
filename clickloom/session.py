"""Session settings the library depends on, and tables written to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# SQL settings that results depend on (the first three) or that keep skewed joins balanced.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",  # the last one counts, instead of no document at all
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

CHECKPOINT_CONF = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings on a session somebody else created."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "clickloom", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


_local_scratch: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    A machine-local folder is only usable when every task runs on this machine, so it is chosen
    in local mode alone.
    """
    shared = spark.conf.get(CHECKPOINT_CONF, None)
    if shared:
        return shared
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="clickloom-")
    return _local_scratch[context.applicationId]


@contextmanager
def compiled_in_parts(spark: SparkSession) -> Iterator[None]:
    """While this holds, generated code that HotSpot would not compile, as a method is too long, is made per operator.

    Rows of very many expressions are otherwise composed by the bytecode interpreter.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")  # the JVM's HugeMethodLimit
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the scratch folder and read it back.

    Unlike a cached plan the written table survives the loss of any executor, and its file sizes
    give the optimizer a measured size to choose join strategies by.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
