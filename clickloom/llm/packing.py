"""Best-fit packing of documents into sequences of fixed length, under conflicts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.common import TIE, WORD_PATTERN
from clickloom.session import materialize

CAPACITY = 1024
DOCS_PER_GROUP = 2048


class Bins:
    """Open bins ordered by the room left in them, each with a bitmap of sources and one of clusters.

    ``level[r]`` holds the bins with room ``r`` by source bitmap, ``open[r]`` counts them and ``taken[s][r]``
    counts those among them that hold source ``s``; so levels where every bin has the source are passed over
    without looking at their bins.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.level: list[dict[int, dict[int, int]]] = [{} for _ in range(capacity + 1)]
        self.open = np.zeros(capacity + 1, np.int64)
        self.taken: dict[int, np.ndarray] = {}
        self.none = np.zeros(capacity + 1, np.int64)
        self.made = 0

    def _move(self, room: int, sources: int, by: int) -> None:
        self.open[room] += by
        while sources:
            low = sources & -sources
            s = low.bit_length() - 1
            if s not in self.taken:
                self.taken[s] = np.zeros(self.capacity + 1, np.int64)
            self.taken[s][room] += by
            sources ^= low

    def tightest(self, size: int, source: int, clusters: int) -> tuple[int, int, int] | None:
        """(room, source bitmap, bin) of the fullest bin that takes the item: the one with the least room at
        least ``size``, the first opened among equals, that has neither the source nor the cluster."""
        taken = self.none if source < 0 else self.taken.get(source, self.none)
        bit = 0 if source < 0 else 1 << source
        for room in np.flatnonzero(self.open[size:] > taken[size:]).tolist():
            best = None
            for bitmap, bins in self.level[room + size].items():
                if not bitmap & bit:
                    for b, held in bins.items():
                        if not held & clusters and (best is None or b < best[2]):
                            best = room + size, bitmap, b
            if best:
                return best
        return None

    def place(self, size: int, source: int, clusters: int) -> tuple[int, int]:
        """The bin an item goes to, and the room it had."""
        bit = 0 if source < 0 else 1 << source
        at = self.tightest(size, source, clusters)
        if at:
            room, bitmap, b = at
            bins = self.level[room][bitmap]
            held = bins.pop(b)
            if not bins:
                del self.level[room][bitmap]
            self._move(room, bitmap, -1)
        else:
            room, bitmap, b, held = self.capacity, 0, self.made, 0
            self.made += 1
        left = room - size
        self.level[left].setdefault(bitmap | bit, {})[b] = held | clusters
        self._move(left, bitmap | bit, 1)
        return b, room


def pack_group(items: pd.DataFrame, capacity: int) -> Iterator[tuple]:
    """(row, piece, bin, offset, size) of one group; ``items`` has size, source and cluster columns.

    Sizes fall, ties go by row order. Pieces that fill a bin get one of their own.
    """
    code = pd.factorize(items["source"])[0].tolist()
    cluster = pd.factorize(items["cluster"])[0]
    # Only clusters with two members in the group can conflict; those get a bit.
    shared = np.flatnonzero(np.bincount(cluster[cluster >= 0], minlength=1) > 1).tolist()
    bit = {c: 1 << i for i, c in enumerate(shared)}
    bins, full, rests = Bins(capacity), [], []
    for row, size in enumerate(items["size"].tolist()):
        pieces, rest = divmod(size, capacity)
        full += [(row, p) for p in range(pieces)]
        if rest:
            rests.append((rest, row, pieces))
    rests.sort(key=lambda x: (-x[0], x[1]))
    for rest, row, piece in rests:
        b, room = bins.place(rest, code[row], bit.get(cluster[row], 0))
        yield row, piece, b, capacity - room, rest
    for i, (row, piece) in enumerate(full):
        yield row, piece, bins.made + i, 0, capacity


def pack(
    docs: DataFrame, capacity: int = CAPACITY, docs_per_group: int = DOCS_PER_GROUP, cluster: str | None = None
) -> DataFrame:
    """Pack documents into bins of ``capacity`` words; no bin holds two documents of one source or one cluster.

    ``cluster`` names a column of duplicate clusters, such as the components of the near-duplicate operator; without
    it documents of one text are a cluster. NULL clusters conflict with nothing.

    A document takes its words and one end mark. Longer ones are cut into full pieces, which fill bins of
    their own, and a rest. Within a group the largest item goes first, into the tightest bin that neither
    has its source nor a member of its cluster; if the tightest has, the search goes on to the next; only if none
    takes it a bin is opened. Rows are dealt into groups at random but repeatably, whatever their source, so
    that each group is one task's work of bounded size and a frequent source or text is spread evenly.

    NULL sources conflict with nothing; NULL and empty texts take only the end mark and conflict with
    nothing; rows may repeat; an empty table gives no rows; other columns are not read.

    Returns doc_id, piece, first_word, n_words, bin, bin_offset.
    """
    text = F.coalesce("text", F.lit(""))
    same = F.when(text != "", F.xxhash64("text"))
    if cluster is not None:
        same = F.when(F.col(cluster).isNotNull(), F.xxhash64(cluster))
    slim = docs.select(
        "doc_id",
        (F.regexp_count(text, F.lit(WORD_PATTERN)) + 1).cast("long").alias("size"),
        F.xxhash64("source").alias("hash_source"),
        F.col("source").isNull().alias("no_source"),
        same.alias("cluster"),
    ).withColumn(TIE, F.monotonically_increasing_id())
    slim = slim.withColumn("source", F.when(~F.col("no_source"), F.col("hash_source"))).drop("hash_source", "no_source")
    stored = materialize(slim, "packing-items")
    groups = max(1, -(-stored.count() // docs_per_group))
    dealt = stored.withColumn("group", F.pmod(F.xxhash64(TIE, F.lit(17)), F.lit(groups)))

    def run(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["doc_id", TIE], ignore_index=True, na_position="first")
        out = pd.DataFrame(pack_group(items, capacity), columns=["row", "piece", "bin", "bin_offset", "n_words"])
        out["doc_id"] = items["doc_id"].astype("Int64").take(out["row"]).array
        out["first_word"] = out["piece"] * capacity
        out["bin"] += (items["group"].iat[0] << 32) if len(items) else 0
        return out[["doc_id", "piece", "first_word", "n_words", "bin", "bin_offset"]]

    return dealt.groupBy("group").applyInPandas(
        run, "doc_id long, piece long, first_word long, n_words long, bin long, bin_offset long"
    )
