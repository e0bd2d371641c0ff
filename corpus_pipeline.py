"""A corpus pipeline: language ID, line dedup, near-dedup, benchmark decontamination and packing.

Every stage works on what the one before kept. All but the last return the columns of ``documents``: line dedup
changes text and n_chars of the documents it cuts, no other value changes, whatever further columns are called.
NULL texts have no letter and go in the first stage, as empty ones do; an empty table stays empty; repeated rows
are documents each, but those that share an id go and stay together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm import decontaminate, language, line_dedup, near_dups, packing
from clickloom.llm.common import WORD_PATTERN, crc_of_id, documents
from clickloom.session import materialize

LEAST_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter, and those whose best language gets less than half the probability.

    The model learns from the documents of this stage's input that are labelled and not held out; if there
    are none, every document is unknown and goes.
    """
    model = language.fit(docs.where(F.coalesce(crc_of_id(5) != 0, F.lit(True))))
    known = (F.col("__lang") != language.UNKNOWN) & (F.col("__share") >= LEAST_LANGUAGE_SCORE)
    return language.predict(docs, model, ("__lang", "__share")).where(known).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that an earlier document holds; a document that loses lines and keeps no word goes."""
    cut = line_dedup.dedup_lines(docs, names=("__lines", "__dropped", "__kept"))
    loses = F.col("__dropped") > 0
    emptied = loses & ~F.col("__kept").rlike(WORD_PATTERN)
    changed = cut.where(~emptied).withColumn("text", F.when(loses, F.col("__kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        size = F.when(loses, F.length("text")).otherwise(F.col("n_chars"))
        changed = changed.withColumn("n_chars", size.cast("long"))
    return changed.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each near-duplicate group."""
    copies = near_dups.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a copy of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = decontaminate.contaminated(docs, benchmark).select("doc_id").distinct()
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["doc_id"]), "left_anti").select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Alignment, classification and packing have no SQL form; tests compare with a brute-force pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    *earlier, (_, last) = STAGES
    for name, stage in earlier:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
