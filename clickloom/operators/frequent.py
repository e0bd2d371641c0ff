"""The most frequent keys of many, exactly, without counting every key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from clickloom.operators.shares import top
from clickloom.schema import quoted
from clickloom.session import materialize

BUCKETS = 65_536
BUCKET = "__bucket"


def most_frequent(
    rows: DataFrame, keys: Sequence[str], k: int, count: str = "event_count", buckets: int = BUCKETS
) -> DataFrame:
    """The ``k`` most frequent values of ``keys`` with their number of rows, ties in key order; NULL is a value.

    The result is that of counting all keys. Rows are first counted by hash bucket of their key, which shuffles
    one row per bucket and task however many keys there are. The keys of the ``k`` largest buckets are then
    counted, and the k-th largest of these counts is a bound: a bucket with fewer rows holds none of the keys
    looked for. Only keys of the other buckets are counted in full. Where the bound certifies nothing (keys of
    about equal frequency, or fewer than ``k`` keys) these are all.
    """
    keyed = materialize(
        rows.select(*[quoted(c) for c in keys], F.pmod(F.xxhash64(*[quoted(c) for c in keys]), F.lit(buckets)).alias(BUCKET)),
        "keys",
    )
    return top(_counted(possible(keyed, keys, k), keys, count), count, [quoted(c) for c in keys], k)


def possible(keyed: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """The rows of ``keyed`` whose bucket may hold one of the ``k`` most frequent keys."""
    sizes = materialize(keyed.groupBy(BUCKET).agg(F.count("*").alias("__rows")), "bucket-sizes")
    largest = sizes.orderBy(F.desc("__rows"), BUCKET).limit(k).select(BUCKET)
    surely = top(_counted(keyed.join(largest, BUCKET, "left_semi"), keys, "__n"), "__n", [], k)
    n, bound = surely.agg(F.count("*"), F.min("__n")).first()
    if n < k:
        return keyed
    # As many rows as buckets: the optimizer broadcasts them by their measured size.
    return keyed.join(sizes.where(F.col("__rows") >= bound).select(BUCKET), BUCKET, "left_semi")


def _counted(rows: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    return rows.groupBy(*[quoted(c) for c in keys]).agg(F.count("*").alias(count))
