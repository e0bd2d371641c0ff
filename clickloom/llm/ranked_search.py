"""Ranked lexical search (op 12): the best documents of every benchmark item, by trees of restricted term vectors."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from clickloom.llm.common import in_small_batches, taken_in, texts_in
from clickloom.llm.fp_tree import Best, TermTree
from clickloom.llm.shingles import PLAIN
from clickloom.session import materialize

#: Bytes of item text searched for in one pass over the documents; more items take more passes.
BLOCK_BYTES = 8 << 20
#: Documents, and entries of their vectors, in one tree.
TREE_DOCS = 8192
TREE_ENTRIES = 1_000_000


def terms_of(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all other characters from U+0080; A-Z in lower case."""
    return text.encode("utf-8", "replace").translate(PLAIN).split()


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tf): every document with a term, restricted to the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_in(batch)):
                words = terms_of(text)
                if words:
                    held = sorted(Counter(filter(None, map(vocabulary.get, words))).items())
                    rows.append((doc_id, len(words), [t for t, _ in held], [n for _, n in held]))
            columns = list(zip(*rows)) or [()] * 4
            types = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "n", "terms", "tf"])

    read = in_small_batches(docs.select(F.col("doc_id").cast("long"), F.col("text")))
    return read.mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<long>")


def _best_of_tasks(vectors: DataFrame, items: list[tuple], weight: dict[int, int], rank: dict[int, int], n: int, total: int, keep: int) -> DataFrame:
    """(item, doc_id, score): the best documents of every item in each task; ``item`` is the place in ``items``."""
    wanted = []
    for terms in items:
        ranked = sorted(rank[t] for t in terms if t in rank)
        wanted.append((np.array(ranked, np.int64), np.array([weight[r] for r in ranked], np.int64)))
    to_rank = np.zeros(max(rank, default=0) + 1, np.int64)
    for term, r in rank.items():
        to_rank[term] = r

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(keep) for _ in items]
        held: list[tuple] = []

        def search():
            m = np.array([50 + (50 * size * n) // total for _, _, size, _ in held], np.int64)
            ids = np.array([i or 0 for *_, i in held], np.int64)
            tree = TermTree([(r, t) for r, t, *_ in held], m, ids, np.array([i is None for *_, i in held]))
            for (terms, weights), found in zip(wanted, best):
                if len(terms):
                    tree.search(terms, weights, found)
            held.clear()

        entries = 0
        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "n", "terms", "tf")]
            starts = columns[2].offsets.to_numpy()
            ranks, tfs = to_rank[columns[2].values.to_numpy()], columns[3].values.to_numpy()
            for i, (doc_id, size) in enumerate(zip(columns[0].to_pylist(), columns[1].to_pylist())):
                part = slice(starts[i], starts[i + 1])
                if part.start == part.stop:
                    continue
                order = np.argsort(ranks[part])
                held.append((ranks[part][order], tfs[part][order], size, doc_id))
                entries += len(order)
                if len(held) >= TREE_DOCS or entries >= TREE_ENTRIES:
                    search()
                    entries = 0
        if held:
            search()
        for number, found in enumerate(best):
            ids = pa.array(found.ids, mask=found.no_id)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), number, np.int32)), ids, pa.array(found.scores)], names=["item", "doc_id", "score"]
            )

    return vectors.select("doc_id", "n", "terms", "tf").mapInArrow(run, "item int, doc_id long, score long")


def _block(docs: DataFrame, items: DataFrame, keep: int) -> DataFrame:
    """Results of items whose texts are known to be few."""
    spark = docs.sparkSession
    terms_by_item: dict[int | None, set[bytes]] = {}
    for row in items.toLocalIterator():
        terms_by_item.setdefault(row["item_id"], set()).update(terms_of(row["text"] or ""))
    # Numbers start at 1: 0 would not pass filter(None, ...).
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*terms_by_item.values())), 1)}
    vectors = materialize(_vectors(docs, vocabulary), "vectors")
    total = vectors.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("total")).first()
    counts = taken_in(vectors.select(F.explode("terms").alias("term")).groupBy("term").count(), "term-counts")
    df = {r["term"]: r["count"] for r in counts}  # at most the vocabulary
    frequent = sorted(df, key=lambda t: (-df[t], t))
    rank = {t: i for i, t in enumerate(frequent)}
    weight = {rank[t]: math.floor(1000 * math.log((2 * total["n"] + 2) / (2 * df[t] + 1))) for t in frequent}
    names = list(terms_by_item)
    items = [[vocabulary[t] for t in terms_by_item[name]] for name in names]
    found = _best_of_tasks(vectors, items, weight, rank, total["n"], total["total"] or 1, keep)
    named = spark.createDataFrame(list(enumerate(names)), "item int, item_id long")
    return found.join(named, "item").select("item_id", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, keep: int = 50) -> DataFrame:
    """The ``keep`` best documents of every item: item_id, rank (from 1), doc_id, score; scores are above 0.

    Items are taken in blocks of bounded text. For a block, one pass over the documents keeps their terms that an
    item holds; then every task puts runs of its documents into trees and searches them for all items, and the
    winners of all tasks are ranked. Nothing is left out: a subtree is passed over only if its bound shows that
    no document in it can be among the best.

    A NULL text has no term; an item without terms, or a document without them, is in no result. Rows that share
    an item_id (NULL is one too) are one item with the terms of all. Repeated documents are ranked each; equal
    scores go by doc_id, NULL first. Columns other than ids and texts are ignored.
    """
    items = items.select(F.col("item_id").cast("long"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    own = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = None
    for b in range(blocks):
        part = _block(docs, items.where(own == b) if blocks > 1 else items, keep)
        found = part if found is None else found.unionByName(part)
    best_first = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    ranked = found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= keep)
    return ranked.select("item_id", "rank", "doc_id", "score")
