"""Counts with their share of the total, top-k reports and bounded value samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top(df: DataFrame, measure: str, ties: Sequence[str], k: int | None = None) -> DataFrame:
    """Largest ``measure`` first, ties in key order, optionally the first ``k`` rows."""
    ordered = df.orderBy(F.desc(measure), *ties)
    return ordered if k is None else ordered.limit(k)


def with_share(
    counts: DataFrame, measure: str, share: str, digits: int, counted: DataFrame
) -> DataFrame:
    """Percent of all ``counted`` rows.

    The total is a scalar subquery over the rows themselves: it needs none of the grouping columns, so it
    costs a bare count, and there is no one-task window over the groups.
    """
    total = counted.agg(F.count("*").cast("double")).scalar()
    percent = F.lit(100.0) * F.col(measure) / total
    return counts.withColumn(share, F.round(percent, digits))


def share_of_total(
    df: DataFrame, value: Column, name: str, digits: int = 1, k: int | None = None
) -> DataFrame:
    counts = df.groupBy(value.alias(name)).agg(F.count("*").alias("cnt"))
    return top(with_share(counts, "cnt", "pct", digits, df), "cnt", [name], k)


def smallest_values(df: DataFrame, group: Sequence[str], value: str, name: str, k: int) -> DataFrame:
    """Per group the ``k`` smallest distinct non-null values as a sorted array.

    The distinct step shuffles on (group, value) and the rank filter keeps at most ``k`` rows per group
    and task before the shuffle on the group, so no task sees a whole group.
    """
    w = Window.partitionBy(*group).orderBy(value)
    return (
        df.where(F.col(value).isNotNull())
        .select(*group, value)
        .distinct()
        .withColumn("__n", F.row_number().over(w))
        .where(F.col("__n") <= k)
        .groupBy(*group)
        .agg(F.array_sort(F.collect_list(value)).alias(name))
    )
