"""Pieces that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F

from clickloom.session import materialize

# White space of the text contracts; everything between such characters is a word.
SPACE = "\x20\t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

TIE, PART = "__tie", "__part"
# Jobs, and so parts of a table, in which the driver takes rows in.
DRIVER_PARTS = 8


# Texts sent to a Python worker at once: a few long ones rather than ten thousand rows of any length.
BATCH_BYTES = "2m"


def in_small_batches(df: DataFrame) -> DataFrame:
    """Bound what a Python worker holds of ``df`` at once, whatever the length of its texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_of_id(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def lower_ascii(text: str) -> str:
    """Lower-case A-Z and nothing else."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def clear_of(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that would clash with the ones an operator adds."""
    return df.drop(*[c for c in names if c in df.columns])


def running_totals(df: DataFrame, order: Sequence[str], totals: dict[str, str], label: str) -> DataFrame:
    """Global exclusive prefix sums, one column per ``totals`` entry (name of the result: summed column).

    A range sort spreads the rows over partitions; each partition sums its own rows in a window, and one
    row of totals per partition goes through the driver to give every partition its offset. Rows that tie
    in ``order`` are told apart by their place in the input, so a frequent key is spread as well.
    """
    tied = materialize(df.withColumn(TIE, F.monotonically_increasing_id()), f"{label}-rows")
    by = [F.col(c).asc_nulls_first() for c in [*order, TIE]]
    laid = materialize(tied.repartitionByRange(*by).withColumn(PART, F.spark_partition_id()), label)
    sums = (
        laid.groupBy(PART)
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"__{name}") for name, c in totals.items()])
        .orderBy(PART)
        .collect()
    )
    before = Window.partitionBy(PART).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    columns = {}
    for name, summed in totals.items():
        offsets, seen = [0] * (sums[-1][PART] + 1 if sums else 1), 0
        for row in sums:
            offsets[row[PART]] = seen
            seen += row[f"__{name}"]
        inside = F.coalesce(F.sum(summed).over(before), F.lit(0))
        columns[name] = (inside + F.get(F.lit(offsets), F.col(PART))).cast("long")
    return laid.withColumns(columns).drop(TIE, PART)


def fold_payloads(df: DataFrame, fold: Callable[[list[bytes] | None, list[bytes]], list[bytes]]) -> DataFrame:
    """Fold the binary columns of all rows with one ``key`` into one row; ``key`` is the first column.

    Rows come sorted by key, so a task holds one accumulator and one row, however many rows a key has.
    """
    schema, names = df.schema, df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(key, state):
            return pa.RecordBatch.from_pydict({n: [v] for n, v in zip(names, [key, *state])}, schema=arrow)

        arrow = key = state = None
        for batch in batches:
            arrow = batch.schema
            for i in range(batch.num_rows):
                now, *payload = (batch.column(c)[i].as_py() for c in range(len(names)))
                if state is not None and now != key:
                    yield row(key, state)
                    state = None
                key, state = now, fold(state, payload)
        if state is not None:
            yield row(key, state)

    key = names[0]
    return df.repartition(F.col(key)).sortWithinPartitions(key).mapInArrow(run, schema)


def taken_in(df: DataFrame, label: str) -> Iterator[Row]:
    """The rows of ``df`` on the driver, a part of them at a time.

    They are written first: an iterator over a shuffled table runs a job for each of its partitions, one after
    the other, even where most of these are empty.
    """
    return materialize(df, label).coalesce(DRIVER_PARTS).toLocalIterator()


def texts_in(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch, NULL as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def chunks_of(lengths: Sequence[int], most: int) -> Iterator[range]:
    """Runs of consecutive positions whose lengths sum to about ``most``; a longer one stands alone."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield range(start, i)
            start, total = i, 0
        total += n
    if len(lengths) > start:
        yield range(start, len(lengths))


_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))
