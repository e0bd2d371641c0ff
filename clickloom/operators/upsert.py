"""Keyed upsert of one or many ranked batches in a single pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from clickloom.schema import EVENT_KEY, quoted
from clickloom.session import materialize


def upsert(
    target: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str] = EVENT_KEY,
    rank: str | None = None,
) -> DataFrame:
    """Delete target rows whose key occurs in the batch, then append the batch.

    ``rank`` orders several deliveries inside ``batch`` (higher is later): a row goes when a later
    delivery has its key, which equals applying them one after the other. Duplicates inside one delivery
    stay, and keys with a NULL part never match. Columns are matched by name; missing ones become NULL.

    The delivered keys are reduced to one row each and written, so the right side of both anti joins is unique,
    of known size and made once, and a hot key on the left can be split. One delivery into nothing is taken as it is.
    """
    if target is None and rank is None:
        return batch
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    ranks = [F.max(rank).alias("__newest"), F.min(rank).alias("__oldest")] if rank is not None else [F.count(F.lit(1)).alias("__n")]
    delivered = materialize(batch.where(complete).groupBy(*keys).agg(*ranks), "delivered-keys")
    named = delivered.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    same_key = reduce(and_, [quoted(k) == F.col(f"__k_{k}") for k in keys])
    appended = batch
    if rank is not None:
        superseded = named.where(F.col("__oldest") < F.col("__newest"))
        appended = batch.join(superseded, same_key & (F.col(rank) < F.col("__newest")), "left_anti").drop(rank)
    if target is None:
        return appended
    return target.join(named, same_key, "left_anti").unionByName(appended, allowMissingColumns=True)
