"""Removal of lines that several documents share."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from clickloom.llm import bloom
from clickloom.llm.common import SPACE, clear_of, fold_payloads, in_small_batches, lower_ascii, taken_in, texts_in
from clickloom.session import materialize

MIN_KEY_CHARS = 10


def line_key(line: str) -> str:
    return lower_ascii(line.strip(SPACE))


def _keys(text: str, least: int) -> list[str]:
    """The distinct keys of a text that are long enough to count."""
    keys = dict.fromkeys(map(line_key, text.split("\n")))
    return [k for k in keys if len(k) >= least]


def _hashes(keys: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k.encode()) for k in keys), np.uint64, len(keys))


def _partial_filters(segments: int, least: int):
    """Per task: which hashes it has seen at all, and which in two documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice, some = bloom.empty(segments), bloom.empty(segments), False
        for batch in batches:
            keys = [k for text in texts_in(batch) for k in _keys(text, least)]
            if not keys:
                continue
            some = True
            h, n = np.unique(_hashes(keys), return_counts=True)
            at = bloom.positions(h, segments)
            again = (n > 1) | bloom.found(once, at)
            bloom.insert(once, at)
            bloom.insert(twice, at[:, again])
        if some:
            again = dict(bloom.packed_segments(twice, segments))
            nothing = zlib.compress(bytes(bloom.SEGMENT_BYTES), 1)
            for s, packed in bloom.packed_segments(once, segments):
                yield pa.RecordBatch.from_pydict(
                    {"segment": pa.array([s], pa.int32()), "once": [packed], "twice": [again.get(s, nothing)]}
                )

    return run


def _merged(state: list[bytes] | None, payload: list[bytes]) -> list[bytes]:
    """A hash was seen twice if either side saw it twice, or both saw it once."""
    once, twice = map(bloom.unpacked, payload)
    if state is not None:
        before, again = map(bloom.unpacked, state)
        once, twice = before | once, again | twice | (before & once)
    return [zlib.compress(once.tobytes(), 1), zlib.compress(twice.tobytes(), 1)]


def _suspects(twice, segments: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bloom.unpacked(twice.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                owners, keys = [], []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), texts_in(part)):
                    own = _keys(text, least)
                    keys += own
                    owners += [doc_id] * len(own)
                if keys:
                    hit = bloom.found(bits, bloom.positions(_hashes(keys), segments))
                    rows = np.flatnonzero(hit)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([keys[i] for i in rows], pa.string()),
                            pa.array([owners[i] for i in rows], batch.schema.field("doc_id").type),
                        ],
                        ["key", "doc_id"],
                    )

    return run


def repeated_lines(docs: DataFrame, least: int = MIN_KEY_CHARS) -> DataFrame:
    """(key, doc_id) of every line that a document must lose: another one with a smaller id holds it.

    Each task fills two Bloom filters with line hashes, one for hashes seen and one for hashes seen in two
    documents; merged, their second one has no false negatives. Only lines that it suspects are shuffled, as
    text, so that confirmation is exact. The merged filter is at most 16 MiB and is broadcast.
    """
    spark = docs.sparkSession
    texts = in_small_batches(docs).where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    newlines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    lines = texts.agg(F.sum(newlines + 1)).first()[0] or 0
    segments = bloom.segments_for(lines)
    partial = texts.mapInArrow(_partial_filters(segments, least), "segment int, once binary, twice binary")
    merged = taken_in(fold_payloads(partial, _merged).select("segment", "twice"), "line-filter")
    shared = spark.sparkContext.broadcast(bloom.gathered(segments, merged))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    suspects = materialize(
        texts.mapInArrow(_suspects(shared, segments, least), f"key string, doc_id {id_type}"), "suspect-lines"
    )
    # Written, so that the join shuffles both sides afresh and a frequent line's partition can be split.
    firsts = materialize(
        suspects.groupBy("key")
        .agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
        .where("first_doc < last_doc")
        .select("key", "first_doc"),
        "line-firsts",
    )
    return suspects.join(firsts, "key").where("doc_id > first_doc").select("key", "doc_id")


def _without(text: pa.Array, keys: pa.Array) -> pa.Array:
    lines, dropped, kept = [], [], []
    for value, lost in zip(text.to_pylist(), keys.to_pylist()):
        own = (value or "").split("\n")
        lines.append(len(own))
        if lost:
            gone = set(lost)
            rest = [x for x in own if line_key(x) not in gone]
        else:
            rest = own
        dropped.append(len(own) - len(rest))
        kept.append("\n".join(rest))
    return pa.StructArray.from_arrays(
        [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())],
        ["n_lines", "n_dropped", "kept_text"],
    )


RESULTS = ("n_lines", "n_dropped", "kept_text")


def dedup_lines(docs: DataFrame, least: int = MIN_KEY_CHARS, names: tuple[str, str, str] = RESULTS) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept_text, under the given names.

    A line's key is the line without white space at its ends, A-Z in lower case. Keys of at least ``least``
    characters that two documents hold stay only in the document with the smallest id, all other lines stay.
    NULL and empty texts have one empty line. Rows that share an id count as one document and lose the same
    keys. Rows without an id neither give nor lose lines. Columns of ``docs`` that have the names of added
    ones are replaced.
    """
    docs = clear_of(docs, *names)
    lost = (
        repeated_lines(docs, least)
        .groupBy(F.col("doc_id").alias("__doc"))
        .agg(F.collect_set("key").alias("__keys"))
    )
    joined = docs.join(lost, docs["doc_id"] == lost["__doc"], "left")
    without = F.arrow_udf(_without, "n_lines long, n_dropped long, kept_text string")
    cut = joined.withColumn("__cut", without("text", "__keys"))
    results = [F.col(f"__cut.{field}").alias(name) for field, name in zip(RESULTS, names)]
    return cut.select(*[docs[c] for c in docs.columns], *results)
