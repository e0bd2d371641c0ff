"""Benchmark decontamination: rare n-gram seeds find passages, Smith-Waterman alignment scores them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm import bloom
from clickloom.llm.common import in_small_batches, mixed
from clickloom.llm.shingles import WordHashes, grams
from clickloom.session import materialize

SEED_WORDS = 3
# An n-gram is common for an item if this many times as many passages hold it as hold the item's median n-gram.
COMMON = 8
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SCORE = 0.5
BROADCAST_WORDS = 1_000_000


def size_class(n_words: int) -> int:
    """Items of 8^c to 8^(c+1)-1 words form class c."""
    return (max(1, n_words).bit_length() - 1) // 3


def _of_class(g: np.ndarray, size: int) -> np.ndarray:
    """N-grams of one size class of items; those of another class are other values."""
    return mixed(g + np.uint64(size))


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of every item and the n-grams among them; items too short for one n-gram give none."""
    memo = WordHashes()
    for batch in batches:
        words = [memo.plain(t or "") for t in batch.column("text").to_pylist()]
        sizes = [size_class(len(w)) for w in words]
        seeds = [
            _of_class(grams(w, SEED_WORDS), c).view(np.int64) if len(w) >= SEED_WORDS else [] for w, c in zip(words, sizes)
        ]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("item"),
                batch.column("item_id"),
                pa.array([w.tobytes() for w in words], pa.binary()),
                pa.array([len(w) for w in words], pa.int64()),
                pa.array(sizes, pa.int32()),
                pa.array(seeds, pa.list_(pa.int64())),
            ],
            ["item", "item_id", "item_words", "n_words", "size", "grams"],
        )


def _passages(shared, segments: int, reach_of: dict[int, int]):
    """Stretches of texts around n-grams that an item may hold, for each size class of items.

    A copy that reaches the least score covers at most twice as many words as its item has, so that many
    words of the class's longest item stand on either side.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, memo = bloom.unpacked(shared.value), WordHashes()
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = memo.plain(text or "")
                if len(words) < SEED_WORDS:
                    continue
                plain = grams(words, SEED_WORDS)
                for size, reach in reach_of.items():
                    g = _of_class(plain, size)
                    at = np.flatnonzero(bloom.found(bits, bloom.positions(g, segments)))
                    for hits in np.split(at, np.flatnonzero(np.diff(at) > reach) + 1) if len(at) else ():
                        start = max(0, int(hits[0]) - reach)
                        stop = int(hits[-1]) + SEED_WORDS + reach
                        for column, value in zip(
                            rows, (doc_id, start, words[start:stop].tobytes(), np.unique(g[hits]).view(np.int64))
                        ):
                            column.append(value)
            kinds = batch.schema.field("doc_id").type, pa.int64(), pa.binary(), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(rows, kinds)], ["doc_id", "start", "words", "grams"]
            )

    return run


def rare_grams(gram: np.ndarray, passages: np.ndarray) -> np.ndarray:
    """The seeds of one item: its distinct n-grams without the common ones.

    ``gram`` holds the item's n-grams in order and ``passages`` how many passages hold each. Common ones are left
    out from the most common on, while the words they cover are fewer than half of the item: a passage that
    shares nothing else cannot reach the least score, and a run of matching words that makes up half of the item
    always has a seed.
    """
    values, first = np.unique(gram, return_index=True)
    held = passages[first]
    limit = COMMON * max(1.0, float(np.median(held))) if len(held) else 0
    covered = np.zeros(len(gram) + SEED_WORDS - 1, bool)
    seed = np.ones(len(values), bool)
    for v in np.lexsort((first, -held)):
        if held[v] <= limit:
            break
        more = covered.copy()
        for at in np.flatnonzero(gram == values[v]):
            more[at : at + SEED_WORDS] = True
        if 2 * int(more.sum()) >= len(more):
            break
        covered, seed[v] = more, False
    return values[seed]


def _rare(grams_of: pa.Array, passages: pa.Array) -> pa.Array:
    """``rare_grams`` of every item of a batch."""
    seeds = [
        rare_grams(np.array(g, np.int64), np.array(n, np.int64)) for g, n in zip(grams_of.to_pylist(), passages.to_pylist())
    ]
    return pa.array(seeds, pa.list_(pa.int64()))


def best_alignment(text: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Score of the best local alignment, and where it ends in the text and in the item.

    Match 2, substitution -1, inserted or missing word -1. Rows of the score table are computed whole: a run
    of inserted words is a running maximum of scores with the gap cost added back.
    """
    slope = GAP * np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    best = (0, 0, 0)
    for i, word in enumerate(item):
        step = np.where(text == word, MATCH, MISMATCH)
        fresh = np.maximum(row + GAP, 0)
        fresh[1:] = np.maximum(fresh[1:], row[:-1] + step)
        row = np.maximum.accumulate(fresh - slope) + slope
        top = int(row.argmax())
        if row[top] > best[0]:
            best = int(row[top]), top, i + 1
    return best


def _aligned(words: pa.Array, item_words: pa.Array, start: pa.Array) -> pa.Array:
    rows = []
    for w, i, s in zip(words, item_words, start.to_pylist()):
        text, item = (np.frombuffer(x.as_buffer(), np.uint64) for x in (w, i))
        # Every point of the score needs a matching word, so with fewer than half of the words it cannot be 0.5.
        enough = np.isin(item, text).sum() >= LEAST_SCORE * len(item)
        score, end, item_end = best_alignment(text, item) if enough else (0, 0, 0)
        share = score / (MATCH * len(item)) if len(item) else 0.0
        # The alignment's start is the end of the best one on reversed sequences.
        back = best_alignment(text[:end][::-1], item[:item_end][::-1])[1] if share >= LEAST_SCORE else 0
        rows.append((share, s + end - back, s + end - 1))
    kinds = pa.float64(), pa.int64(), pa.int64()
    return pa.StructArray.from_arrays(
        [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 3, kinds)], ["score", "first_word", "last_word"]
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold a copy of a benchmark item, whole or edited, and where.

    Words are lower-cased and freed of ASCII punctuation. Texts are read once: a Bloom filter of all the items'
    word 3-grams (16 MiB at most) picks the stretches around possible hits, by size class of the items. An item's
    seeds are its n-grams without those that are common among these stretches (see ``rare_grams``). Stretches that
    share a seed with an item are aligned with it, but for those that hold fewer than half of the item's words;
    the score is the alignment's share of the score of a whole verbatim copy, and 0.5 or more is contamination.
    A copy that keeps no three consecutive words, or only common ones, has no seed and is not found.

    Items with fewer than three words or a NULL text match nothing; repeated items are judged one by one; texts
    that are NULL or shorter match nothing. A document without an id appears with a NULL id. Other columns are
    not read.

    Returns doc_id, item_id, score, first_word, last_word (of the best copy), one row per document and item.
    """
    spark = docs.sparkSession
    numbered = benchmark.select("item_id", "text").withColumn("item", F.monotonically_increasing_id())
    items = materialize(
        numbered.mapInArrow(
            _item_words, "item long, item_id long, item_words binary, n_words long, size int, grams array<long>"
        ),
        "benchmark-items",
    )
    positions = items.select("item", F.posexplode("grams").alias("at", "gram"))
    # A row per size class: item lengths are below 2^31, so there are at most eleven.
    classes = items.groupBy("size").agg(F.max("n_words"), F.sum("n_words"), F.sum(F.size("grams"))).collect()
    n_words, n_grams = (sum(row[i] for row in classes) for i in (2, 3))
    segments = bloom.segments_for(n_grams, 64)
    shared = spark.sparkContext.broadcast(bloom.filter_of(positions.select("gram"), segments))
    reach_of = {size: 2 * longest for size, longest, _, held in classes if held}
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = in_small_batches(docs).select("doc_id", "text").mapInArrow(
        _passages(shared, segments, reach_of),
        f"doc_id {id_type}, start long, words binary, grams array<long>",
    )
    passages = materialize(found.withColumn("passage", F.monotonically_increasing_id()), "passages")
    small = n_words <= BROADCAST_WORDS
    hits = passages.select("passage", F.explode("grams").alias("gram"))
    held = hits.groupBy("gram").agg(F.count(F.lit(1)).alias("n_passages"))
    in_order = F.array_sort(F.collect_list(F.struct("at", "gram", F.coalesce("n_passages", F.lit(0)).alias("n"))))
    counted = positions.join(held, "gram", "left").groupBy("item").agg(in_order.alias("g"))
    rare = F.arrow_udf(_rare, "array<long>")
    seeds = materialize(counted.select("item", F.explode(rare("g.gram", "g.n")).alias("gram")), "seeds")
    pairs = hits.join(F.broadcast(seeds) if small else seeds, "gram").select("passage", "item").distinct()
    texts = items.select("item", "item_id", "item_words")
    aligned = F.arrow_udf(_aligned, "score double, first_word long, last_word long")
    scored = (
        pairs.join(passages.select("passage", "doc_id", "start", "words"), "passage")
        .join(F.broadcast(texts) if small else texts, "item")
        .withColumn("aligned", aligned("words", "item_words", "start"))
        .select("doc_id", "item_id", "aligned.*")
        .where(F.col("score") >= LEAST_SCORE)
    )
    best = F.max_by(F.struct("first_word", "last_word"), F.struct("score", -F.col("first_word"), -F.col("last_word")))
    return scored.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), best.alias("at")).select(
        "doc_id", "item_id", "score", "at.*"
    )
