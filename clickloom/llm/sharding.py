"""Contiguous shards of balanced byte size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.llm.common import running_totals
from clickloom.session import materialize

RECORD_BYTES = 8


def shard_by_bytes(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Put documents, in the order of their ids, into ``shards`` runs of nearly equal byte size.

    A document's size is its UTF-8 text (NULL: none) plus eight bytes. It goes to the shard that the middle
    of its byte range falls into when the whole range is cut at equal targets, so every cut is at most half
    a document away from its target. Only id, size and checksum are shuffled.

    NULL ids come first; rows with equal ids keep some order among themselves; an empty table gives no rows;
    a document larger than a shard's target leaves neighbouring shards empty. Columns of ``docs`` other than
    ``doc_id`` and ``text`` are not read.

    Returns doc_id, size, text_crc32, shard, slot (from 0 in each shard).
    """
    digest = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(1).cast("long").alias("one"),
    )
    placed = materialize(
        running_totals(digest, ["doc_id", "text_crc32"], {"start": "size", "index": "one"}, "shard-bytes"),
        "shard-placed",
    )
    total = placed.agg(F.max(F.col("start") + F.col("size"))).first()[0] or 1
    middle = F.col("start") * 2 + F.col("size")
    cut = placed.withColumn("shard", F.floor(middle * shards / F.lit(2 * total)).cast("int"))
    # One row per shard.
    firsts = {r["shard"]: r["first"] for r in cut.groupBy("shard").agg(F.min("index").alias("first")).collect()}
    first = F.get(F.lit([firsts.get(s, 0) for s in range(shards)]), F.col("shard"))
    return cut.select("doc_id", "size", "text_crc32", "shard", (F.col("index") - first).alias("slot"))
