"""Lag, position and running values inside ordered groups, for groups of any size.

A window function sorts one group in one task. That is the right plan while groups are small, and the one
used for all of them except the hot ones: groups larger than ``HotGroups.min_rows`` are laid out in range
partitions over (keys, order), so one group spreads over many tasks. Each slice gets its local window
values; what a slice needs from the slices before it (last row, row count, running value) is one small row
per slice and key, joined back as a broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.schema import quoted
from clickloom.session import materialize

SEQ, SLICE, RANK = "__seq", "__slice", "__rank"
# Buckets of a size count: so many for each time the rows reach the limit, and no more than these.
BUCKETS_PER_LIMIT, MOST_BUCKETS = 8, 1 << 24


@dataclass(frozen=True)
class HotGroups:
    """When to split a group: above ``min_rows`` rows. ``slice_rows`` is the size of the parts aimed at.

    ``buckets`` is the number of hash buckets that are counted first (more if rows need them); only groups in
    a bucket above ``min_rows`` are counted one by one.
    """

    min_rows: int = 2_000_000
    slice_rows: int = 1_000_000
    buckets: int = 65_536


@dataclass(frozen=True)
class Ordered:
    """What to add to each row of a group.

    ``lags``: new column -> column of the previous row.
    ``max_before``: new column -> column whose maximum over all earlier rows is wanted.
    ``position``: name of the 1-based row number.
    ``derive``: adds columns computed from the ones above.
    ``running_sum``: new column -> (possibly derived) column to sum up to and including the row.
    """

    lags: dict[str, str] = field(default_factory=dict)
    max_before: dict[str, str] = field(default_factory=dict)
    position: str | None = None
    derive: Callable[[DataFrame], DataFrame] | None = None
    running_sum: dict[str, str] = field(default_factory=dict)


def hot_groups(df: DataFrame, keys: Sequence[str], policy: HotGroups) -> DataFrame | None:
    """Keys and sizes (``__rows``) of the groups to split; None if there is none.

    Rows are first counted per hash bucket of their key. A group above the limit makes its bucket large, so
    usually nothing is left to count; otherwise only groups in large buckets are. Where rows are so many that
    buckets are large without a hot group, they are counted again in as many buckets as the rows need. The
    groups found are at most rows / min_rows; like the buckets they stay in a table.
    """
    columns = [quoted(k) for k in keys]

    def counted(buckets: int) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*columns), F.lit(buckets))
        return df.groupBy(bucket.alias("__bucket")).agg(F.count("*").alias("__rows"))

    buckets, is_large = policy.buckets, F.col("__rows") > policy.min_rows
    while True:
        total, large = counted(buckets).agg(F.sum("__rows"), F.count_if(is_large)).first()
        if not large:
            return None
        needed = 1 << (BUCKETS_PER_LIMIT * total // policy.min_rows).bit_length()
        if needed <= buckets or buckets >= MOST_BUCKETS:
            break
        buckets = min(needed, MOST_BUCKETS)
    rows = df.withColumn("__bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets)))
    if 2 * large < buckets:  # else nearly all rows would stay
        rows = rows.join(materialize(counted(buckets).where(is_large), "large-buckets"), "__bucket", "left_semi")
    sizes = rows.groupBy(*columns).agg(F.count("*").alias("__rows"))
    found = materialize(sizes.where(is_large), "hot-groups")
    return None if found.isEmpty() else found


def add_ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    wanted: Ordered,
    policy: HotGroups | None = HotGroups(),
) -> DataFrame:
    """``df`` with the ``wanted`` columns; NULLs order last. ``policy=None`` skips the size check."""
    found = None if policy is None else hot_groups(df, keys, policy)
    if found is None:
        return _in_one_task(df, keys, order, wanted)
    slices = 1 + found.agg(F.sum("__rows")).first()[0] // policy.slice_rows
    hot = found.select(*[quoted(k).alias(f"__hot_{k}") for k in keys])
    # The optimizer broadcasts the keys if their table is small, and otherwise joins by them.
    same_key = _all_equal((F.col(f"__hot_{k}"), df[quoted_name(k)]) for k in keys)
    cold_rows = df.join(hot, same_key, "left_anti")
    hot_rows = df.join(hot, same_key, "left_semi")
    plain = _in_one_task(cold_rows, keys, order, wanted)
    return plain.unionByName(_in_slices(hot_rows, keys, order, wanted, slices))


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _all_equal(pairs) -> Column:
    condition = F.lit(True)
    for left, right in pairs:
        condition = condition & left.eqNullSafe(right)
    return condition


def _nulls_last(order: Sequence[str]) -> list[Column]:
    return [quoted(c).asc_nulls_last() for c in order]


def _windows(keys: Sequence[str], order: Sequence[str]):
    w = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*_nulls_last(order))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    up_to = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return w, before, up_to


def _in_one_task(df: DataFrame, keys, order, wanted: Ordered) -> DataFrame:
    w, before, up_to = _windows(keys, order)
    out = df.withColumns(
        {name: F.lag(quoted(source)).over(w) for name, source in wanted.lags.items()}
        | {name: F.max(quoted(source)).over(before) for name, source in wanted.max_before.items()}
        | ({wanted.position: F.row_number().over(w)} if wanted.position else {})
    )
    if wanted.derive:
        out = wanted.derive(out)
    return out.withColumns(
        {name: F.sum(quoted(source)).over(up_to) for name, source in wanted.running_sum.items()}
    )


def _in_slices(df: DataFrame, keys, order, wanted: Ordered, slices: int) -> DataFrame:
    # The sequence number makes every row distinct, so even copies of one row can be spread. It is
    # written before it decides where rows go: recomputing a lost task then reads the same numbers.
    numbered = materialize(df.withColumn(SEQ, F.monotonically_increasing_id()), "hot-rows")
    full_order = [*order, SEQ]
    by_range = [*[quoted(k) for k in keys], *_nulls_last(full_order)]
    spread = numbered.repartitionByRange(slices, *by_range)
    layout = materialize(spread.withColumn(SLICE, F.spark_partition_id()), "hot-slices")

    slice_keys = [SLICE, *keys]
    w, before, up_to = _windows(slice_keys, full_order)
    local = layout.withColumns(
        {name: F.lag(quoted(source)).over(w) for name, source in wanted.lags.items()}
        | {name: F.max(quoted(source)).over(before) for name, source in wanted.max_before.items()}
        | {RANK: F.row_number().over(w)}
    )

    # Group ranges are contiguous, so there are at most (slices + hot groups) of these rows.
    history = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(SLICE)
    earlier = history.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        local.groupBy(*[quoted(k) for k in slice_keys])
        .agg(
            F.count("*").alias("__rows"),
            *[
                F.max_by(F.struct(quoted(source)), F.col(RANK)).alias(f"__last_{name}")
                for name, source in wanted.lags.items()
            ],
            *[
                F.max(quoted(source)).alias(f"__max_{name}")
                for name, source in wanted.max_before.items()
            ],
        )
        .select(
            *[quoted(k).alias(f"__c_{k}") for k in slice_keys],
            F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__offset"),
            *[
                F.lag(f"__last_{name}").over(history)[source].alias(f"__prev_{name}")
                for name, source in wanted.lags.items()
            ],
            *[
                F.max(f"__max_{name}").over(earlier).alias(f"__premax_{name}")
                for name in wanted.max_before
            ],
        )
    )
    joined = _join_slices(local, carried, slice_keys)
    out = joined.withColumns(
        {
            name: F.when(F.col(RANK) == 1, F.col(f"__prev_{name}")).otherwise(quoted(name))
            for name in wanted.lags
        }
        | {
            # greatest() ignores NULLs
            name: F.greatest(quoted(name), F.col(f"__premax_{name}"))
            for name in wanted.max_before
        }
        | (
            {wanted.position: (F.col(RANK) + F.col("__offset")).cast("int")}
            if wanted.position
            else {}
        )
    )
    out = out.drop(*[c for c in carried.columns])
    if wanted.derive:
        out = wanted.derive(out)
    if wanted.running_sum:
        out = _running_sums(out, slice_keys, keys, up_to, history, earlier, wanted)
    return out.drop(SEQ, SLICE, RANK)


def _running_sums(out, slice_keys, keys, up_to, history, earlier, wanted: Ordered) -> DataFrame:
    totals = (
        out.groupBy(*[quoted(k) for k in slice_keys])
        .agg(*[F.sum(quoted(s)).alias(f"__sum_{n}") for n, s in wanted.running_sum.items()])
        .select(
            *[quoted(k).alias(f"__c_{k}") for k in slice_keys],
            *[
                F.sum(f"__sum_{n}").over(earlier).alias(f"__presum_{n}")
                for n in wanted.running_sum
            ],
        )
    )
    local = out.withColumns({n: F.sum(quoted(s)).over(up_to) for n, s in wanted.running_sum.items()})
    joined = _join_slices(local, totals, slice_keys)
    zero = F.lit(0)
    return joined.withColumns(
        {
            n: F.when(
                quoted(n).isNotNull() | F.col(f"__presum_{n}").isNotNull(),
                F.coalesce(quoted(n), zero) + F.coalesce(F.col(f"__presum_{n}"), zero),
            )
            for n in wanted.running_sum
        }
    ).drop(*totals.columns)


def _join_slices(local: DataFrame, carried: DataFrame, slice_keys: Sequence[str]) -> DataFrame:
    same = _all_equal((local[quoted_name(k)], carried[quoted_name(f"__c_{k}")]) for k in slice_keys)
    return local.join(carried, same, "left")
