"""Dense 1..n surrogate keys in a global order without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from clickloom.schema import quoted
from clickloom.session import materialize

# monotonically_increasing_id() keeps the partition in the upper bits, the row in the lower 33.
ROW_BITS = (1 << 33) - 1


def with_dense_key(df: DataFrame, order: Sequence[str], key: str) -> DataFrame:
    """Number the rows of ``df``, whose ``order`` columns must identify them, from 1.

    A range sort spreads the rows; each partition numbers its own. The sorted table is written so that
    numbering and partition sizes come from the same layout. Only one count per partition reaches the
    driver, where it becomes a literal: the result stays a projection of a table of known size.
    """
    by = [quoted(c).asc() for c in order]
    row_id = F.monotonically_increasing_id()
    numbered = materialize(
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumns({"__part": F.spark_partition_id(), "__row": row_id.bitwiseAND(F.lit(ROW_BITS))}),
        key,
    )
    sizes = numbered.groupBy("__part").agg((F.max("__row") + 1).alias("n")).orderBy("__part").collect()
    offsets, seen = {}, 0
    for part, n in sizes:
        offsets[part], seen = seen, seen + n
    offset = F.lit(0)
    if offsets:
        by_part = F.lit([offsets.get(p, 0) for p in range(max(offsets) + 1)])
        offset = F.get(by_part, F.col("__part"))
    position = (F.col("__row") + offset + 1).cast("long")
    return numbered.select(position.alias(key), *[quoted(c) for c in df.columns])
