"""Bloom filters over 64-bit hashes, cut into segments so that they can be merged in parallel."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clickloom.llm.common import fold_payloads, taken_in

SEGMENT_BITS = 1 << 19
SEGMENT_BYTES = SEGMENT_BITS // 8
PROBES = 4
MAX_SEGMENTS = 256


def segments_for(hashes: int, bits_each: int = 10) -> int:
    """A power of two of segments giving ``bits_each`` bits per hash, at most MAX_SEGMENTS (16 MiB).

    Beyond that bound a filter answers "perhaps" more often and stays correct.
    """
    n = 1
    while n < MAX_SEGMENTS and n * SEGMENT_BITS < hashes * bits_each:
        n *= 2
    return n


def positions(h: np.ndarray, segments: int) -> np.ndarray:
    """The bits of each hash, all inside the segment that its upper bits name; shape (probes, hashes)."""
    segment = (h >> np.uint64(32)) % np.uint64(segments)
    low, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(40)) | np.uint64(1)
    probes = [(low + np.uint64(i) * step) % np.uint64(SEGMENT_BITS) for i in range(PROBES)]
    return np.stack(probes) + segment * np.uint64(SEGMENT_BITS)


def empty(segments: int) -> np.ndarray:
    return np.zeros(segments * SEGMENT_BYTES, np.uint8)


def insert(bits: np.ndarray, at: np.ndarray) -> None:
    at = at.ravel()
    np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def found(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    byte = bits[(at >> np.uint64(3)).astype(np.int64)]
    return ((byte >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def gathered(segments: int, rows) -> bytes:
    """The whole packed filter from (segment, packed bits) rows; at most 16 MiB before packing."""
    bits = empty(segments)
    for segment, packed in rows:
        at = segment * SEGMENT_BYTES
        bits[at : at + SEGMENT_BYTES] = np.frombuffer(zlib.decompress(packed), np.uint8)
    return zlib.compress(bits.tobytes(), 1)


def packed_segments(bits: np.ndarray, segments: int) -> Iterator[tuple[int, bytes]]:
    for s in range(segments):
        part = bits[s * SEGMENT_BYTES : (s + 1) * SEGMENT_BYTES]
        if part.any():
            yield s, zlib.compress(part.tobytes(), 1)


def unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint8)


def filter_of(hashes: DataFrame, segments: int) -> bytes:
    """The packed filter of a table with one column of 64-bit hashes."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = empty(segments)
        for batch in batches:
            insert(bits, positions(batch.column(0).to_numpy().view(np.uint64), segments))
        for s, packed in packed_segments(bits, segments):
            yield pa.RecordBatch.from_pydict({"segment": pa.array([s], pa.int32()), "bits": [packed]})

    def merge(state: list[bytes] | None, payload: list[bytes]) -> list[bytes]:
        if state is None:
            return payload
        return [zlib.compress((unpacked(state[0]) | unpacked(payload[0])).tobytes(), 1)]

    parts = fold_payloads(hashes.mapInArrow(fill, "segment int, bits binary"), merge)
    return gathered(segments, taken_in(parts, "filter"))
