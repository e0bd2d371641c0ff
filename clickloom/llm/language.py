"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.common import chunks_of, clear_of, fold_payloads, in_small_batches, taken_in

ORDERS = (1, 2, 3)
BUCKET_BITS = 16
MODEL_BYTES = 128 << 20
CHUNK_CHARS = 1 << 19
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


def _buckets(points: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The bucket of each n-gram, one array for each order."""
    for n in ORDERS:
        if len(points) < n:
            yield np.empty(0, np.uint32)
            continue
        h = np.full(len(points) - n + 1, n, np.uint32)
        for i in range(n):
            h = (h ^ points[i : len(points) - n + 1 + i]) * _FACTORS[i]
            h ^= h >> np.uint32(15)
        yield h >> np.uint32(32 - bits)


def _slices(points: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in overlapping parts, so that no n-gram is lost; n-grams inside an overlap of lower order
    count twice there, a few characters in half a million."""
    for start in range(0, max(1, len(points)), CHUNK_CHARS):
        yield points[start : start + CHUNK_CHARS + max(ORDERS) - 1]


def _partial_counts(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            texts: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, own in texts.items():
                docs[lang] = docs.get(lang, 0) + len(own)
                total = counts.setdefault(lang, np.zeros(1 << bits, np.int64))
                for part in chunks_of([len(t) for t in own], CHUNK_CHARS):
                    for points in _slices(_code_points("\n".join(own[i] for i in part))):
                        for h in _buckets(points, bits):
                            total += np.bincount(h, minlength=1 << bits)
        for lang, total in counts.items():
            payload = np.append(total, docs[lang]).tobytes()
            yield pa.RecordBatch.from_pydict({"lang": [lang], "counts": pa.array([payload], pa.binary())})

    return run


def _summed(state: list[bytes] | None, payload: list[bytes]) -> list[bytes]:
    if state is None:
        return payload
    return [(np.frombuffer(state[0], np.int64) + np.frombuffer(payload[0], np.int64)).tobytes()]


@dataclass(frozen=True)
class LanguageModel:
    """Languages, and a (buckets, languages) matrix of log probabilities with the log priors."""

    langs: list[str]
    bits: int
    matrix: Broadcast | None


def fit(labelled: DataFrame, alpha: float = 0.1, bits: int = BUCKET_BITS) -> LanguageModel:
    """Count hashed character n-grams of orders 1 to 3 per language over all rows of ``labelled`` (text, lang).

    Rows whose text or lang is NULL teach nothing. There are 2^bits buckets whatever the data; a matrix of more
    than 128 MiB (512 languages with 16 bits) is refused with a ValueError, for the caller to choose fewer bits.
    """
    spark = labelled.sparkSession
    rows = in_small_batches(labelled).where("text is not null and lang is not null").select("lang", "text")
    n_langs = labelled.where("lang is not null").agg(F.count_distinct("lang")).first()[0]
    if (n_langs << bits) * 4 > MODEL_BYTES:
        raise ValueError(f"{n_langs} languages with {bits} bits take more than {MODEL_BYTES} bytes; choose fewer bits")
    partial = rows.mapInArrow(_partial_counts(bits), "lang string, counts binary")
    langs, columns, docs = [], [], []
    for lang, payload in sorted(map(tuple, taken_in(fold_payloads(partial, _summed), "language-counts"))):
        counts = np.frombuffer(payload, np.int64)
        langs.append(lang)
        docs.append(counts[-1])
        smooth = counts[:-1] + alpha
        columns.append(np.log(smooth / smooth.sum()).astype(np.float32))
    if not langs:
        return LanguageModel([], bits, None)
    prior = np.log(np.array(docs) / np.sum(docs))
    return LanguageModel(langs, bits, spark.sparkContext.broadcast((np.column_stack(columns), prior)))


def _log_likelihoods(texts: list[str], matrix: np.ndarray, bits: int) -> np.ndarray:
    """The summed log probability of every text under every language."""
    out = np.zeros((len(texts), matrix.shape[1]))
    for part in chunks_of([len(t) for t in texts], CHUNK_CHARS):
        if len(part) == 1:
            for points in _slices(_code_points(texts[part[0]])):
                for h in _buckets(points, bits):
                    out[part[0]] += matrix[h].sum(axis=0, dtype=np.float64)
            continue
        points = [_code_points(texts[i]) for i in part]
        sizes = np.array([len(p) for p in points])
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        flat = np.concatenate(points)
        if not len(flat):
            continue
        total = np.zeros((len(flat), matrix.shape[1]), np.float32)
        for n, h in zip(ORDERS, _buckets(flat, bits)):
            values = matrix[h]
            for back in range(1, n):  # n-grams that run over a text's end belong to none
                ends = (starts + sizes - back)[sizes >= back]
                values[ends[ends < len(values)]] = 0
            total[: len(values)] += values
        some = np.flatnonzero(sizes)
        out[np.asarray(part)[some]] = np.add.reduceat(total, starts[some], axis=0, dtype=np.float64)
    return out


def predict(docs: DataFrame, model: LanguageModel, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with lang_pred and score, the posterior probability of that language, under the given names.

    ``und`` with score 0 for texts that are NULL or have no letter, and for all texts if nothing was learned.
    Columns of ``docs`` with these names are replaced; no other column than text is looked at.
    """
    langs, bits, matrix = model.langs, model.bits, model.matrix

    @F.arrow_udf("lang_pred string, score double")
    def scored(text: pa.Array) -> pa.Array:
        values = text.to_pylist()
        known = [i for i, t in enumerate(values) if t is not None and _LETTER.search(t)] if langs else []
        names, scores = [UNKNOWN] * len(values), [0.0] * len(values)
        if known:
            weights, prior = matrix.value
            log = _log_likelihoods([values[i] for i in known], weights, bits) + prior
            best = log.argmax(axis=1)
            share = 1 / np.exp(log - log.max(axis=1, keepdims=True)).sum(axis=1)
            for i, b, s in zip(known, best.tolist(), share.tolist()):
                names[i], scores[i] = langs[b], s
        return pa.StructArray.from_arrays([pa.array(names), pa.array(scores)], ["lang_pred", "score"])

    docs = clear_of(in_small_batches(docs), *names)
    results = [F.col(f"__scored.{field}").alias(name) for field, name in zip(("lang_pred", "score"), names)]
    return docs.withColumn("__scored", scored("text")).select(*docs.columns, *results)
