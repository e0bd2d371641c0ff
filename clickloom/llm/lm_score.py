"""Scores of texts under a byte context tree and under an add-one unigram model, both learned from a corpus."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from clickloom.llm import context_tree
from clickloom.llm.common import chunks_of, in_small_batches
from clickloom.llm.shingles import WordHashes
from clickloom.session import materialize

DEPTH = 5
# Contexts of this many bytes make the groups of work: 2^24 of them, each with at most 2^24 grams.
TOP = 3
HEAD_GRAMS = 1 << 21
HEAD_TOKENS = 1 << 20
BUCKETS_PER_OCTAVE = 16
_CHUNK_BYTES = 4 << 20
_FLUSH = 1 << 21
_BLOCK_ROWS = 1 << 17
_HELD_OUT = 1 << 8 * (DEPTH + 1)
# The end of a text counts as a token; a word never has a blank.
END_TOKEN = xxhash.xxh64_intdigest(b" ")
_STATE = ("done", "left", "edge")


def _lowered(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode("utf-8", "replace").lower() for t in batch.column("text").to_pylist()]


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64)


def _counted(values_of, name: str):
    """Counts of 64-bit values of a task's texts; sent on whenever many distinct ones have come together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(keys, n):
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], [name, "n"])

        values, parts, held = values_of(), [], 0
        for batch in batches:
            texts, held_out = _lowered(batch), batch.column("held_out").to_pylist()
            for part in chunks_of([len(t) for t in texts], _CHUNK_BYTES):
                rows = slice(part.start, part.stop)
                parts.append(np.unique(values(texts[rows], held_out[rows]), return_counts=True))
                held += len(parts[-1][0])
                if held > _FLUSH:
                    parts = [_summed(parts)]
                    held = len(parts[0][0])
                    if held > _FLUSH // 2:
                        yield row(*parts[0])
                        parts, held = [], 0
        if held:
            yield row(*_summed(parts))

    return run


def _gram_values():
    def values(texts, held_out):
        kinds = [[t for t, out in zip(texts, held_out) if bool(out) == kind] for kind in (False, True)]
        taught, others = (context_tree.grams_of(k, DEPTH) if k else np.zeros(0, np.uint64) for k in kinds)
        return np.concatenate([taught, others | np.uint64(_HELD_OUT)])

    return values


def _token_values():
    memo = WordHashes()
    return lambda texts, _: np.concatenate([_tokens(memo, t) for t in texts])


def _tokens(memo: WordHashes, lowered: bytes) -> np.ndarray:
    words = lowered.split()
    return np.fromiter((*map(memo.__getitem__, words), END_TOKEN), np.uint64, len(words) + 1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of runs of whole groups; rows come in order of the first column, their group."""
    held, size = [], 0
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
        if not batch.num_rows:
            continue
        if size >= _BLOCK_ROWS:
            last = held[-1][0][-1]
            cut = int(np.searchsorted(columns[0], last, side="right"))
            if cut < batch.num_rows:
                yield [np.concatenate(c) for c in zip(*held, [c[:cut] for c in columns])]
                held, size = [], 0
                columns = [c[cut:] for c in columns]
        held.append(columns)
        size += len(columns[0])
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, gram, n in _blocks(batches):
        for step in range(context_tree.STEPS):
            _, levels, weight = context_tree.climb(gram.astype(np.uint64), n, step, DEPTH, TOP)
            top = levels[-1]
            columns = [top.key.view(np.int64), top.zeros, top.ones, weight]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "zeros", "ones", "weight"])


def _predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, code, is_gram, n, met, done, left, edge in _blocks(batches):
        is_gram = is_gram.astype(bool)
        gram, n, met = code[is_gram].astype(np.uint64), n[is_gram], met[is_gram]
        above = code[~is_gram].astype(np.uint64)
        order = np.argsort(above)
        state = [x[~is_gram][order] for x in (done, left, edge)]
        log10 = np.zeros(len(gram))
        for step in range(context_tree.STEPS):
            where, levels, _ = context_tree.climb(gram, n, step, DEPTH, TOP)
            at = np.searchsorted(above[order], levels[-1].key)
            one = context_tree.descend(levels, *[x[at] for x in state])[where]
            log10 += np.log10(np.where(context_tree.one_bits(gram, step), one, 1 - one))
        columns = [gram.view(np.int64), met, log10.astype(np.float32)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "met", "log10"])


@F.pandas_udf(DoubleType())
def _kt(zeros: pd.Series, ones: pd.Series) -> pd.Series:
    return pd.Series(context_tree.kt(zeros.to_numpy(np.float64), ones.to_numpy(np.float64)))


def _above(depth: int):
    return F.col("key").bitwiseAND(F.lit(context_tree.key_mask(depth)).cast("long"))


def _states_above(tops: DataFrame) -> DataFrame:
    """For every node ``TOP`` bytes deep, what the shorter contexts give: weighed up to the root, mixed on the way down."""
    levels, lower = [], tops
    for d in reversed(range(TOP)):
        sums = [F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weight").alias("rest")]
        level = lower.groupBy(_above(d).alias("key")).agg(*sums).withColumn("own", _kt("zeros", "ones"))
        apart = F.log1p(F.exp(-F.abs(F.col("own") - F.col("rest"))))
        lower = materialize(level.withColumn("weight", F.greatest("own", "rest") + apart - math.log(2)), f"contexts-{d}")
        levels.append(lower)
    state = None
    for d, level in enumerate(reversed(levels)):
        if d:
            level = level.withColumn("up", _above(d - 1)).join(state, "up")
        else:
            level = level.withColumns({"done": F.lit(0.0), "left": F.lit(1.0), "edge": F.lit(0.5)})
        seen = F.col("zeros") + F.col("ones") > 0
        guess = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
        apart = F.greatest(F.least(F.col("rest") - F.col("own"), F.lit(500.0)), F.lit(-500.0))
        trust = F.when(seen, 1 / (1 + F.exp(apart))).otherwise(0.0)
        state = level.select(
            F.col("key").alias("up"),
            (F.col("done") + F.col("left") * trust * guess).alias("done"),
            (F.col("left") * (1 - trust)).alias("left"),
            F.when(seen, F.col("done") + F.col("left") * guess).otherwise(F.col("edge")).alias("edge"),
        )
    return tops.select("key", _above(TOP - 1).alias("up")).join(state, "up").drop("up")


def fit_grams(texts: DataFrame) -> DataFrame:
    """Every byte after its last five, over all texts, with how often it was met and its log10 probability.

    Counts come from the texts that are not held out, and all their contexts are in the model, however rare.
    The trees are weighed level by level: contexts of five to three bytes inside groups of the last three bytes,
    which 2^24 grams bound, shorter ones by aggregation. Grams of held-out texts are rows without a count, so
    that they get their probability as well. Nothing is gathered by the driver.
    """
    counted = texts.mapInArrow(_counted(_gram_values, "gram"), "gram long, n long")
    taught = F.col("gram") < _HELD_OUT
    grams = counted.groupBy(F.col("gram").bitwiseAND(F.lit(_HELD_OUT - 1).cast("long")).alias("gram")).agg(
        F.sum(F.when(taught, F.col("n")).otherwise(0)).alias("n"), F.sum("n").alias("met")
    )
    group = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * TOP) - 1).cast("long"))
    grams = materialize(grams.withColumn("group", group), "grams")
    tops = grams.select("group", "gram", "n").repartition("group").sortWithinPartitions("group")
    tops = materialize(tops.mapInArrow(_weigh, "key long, zeros double, ones double, weight double"), "contexts-top")
    none = F.lit(0.0)
    columns = [F.col("gram").alias("code"), F.lit(1).alias("is_gram"), "n", "met", *[none.alias(c) for c in _STATE]]
    own = grams.select("group", *columns)
    zero = F.lit(0).cast("long")
    columns = [F.col("key").alias("code"), F.lit(0).alias("is_gram"), zero.alias("n"), zero.alias("met"), *_STATE]
    states = _states_above(tops).select(F.shiftright("key", 8).alias("group"), *columns)
    laid = own.unionByName(states).repartition("group").sortWithinPartitions("group")
    return materialize(laid.mapInArrow(_predict, "gram long, met long, log10 float"), "gram-scores")


def head_of(grams: DataFrame) -> context_tree.GramTable:
    """At most ``HEAD_GRAMS`` of the grams met most often, whole size classes of them; the others are joined."""
    octave = F.floor(F.log2("met") * BUCKETS_PER_OCTAVE).cast("int")
    # A row per size class.
    classes = grams.groupBy(octave.alias("octave")).count().orderBy(F.desc("octave")).collect()
    room, least = HEAD_GRAMS, None
    for row in classes:
        room -= row["count"]
        if room < 0:
            break
        least = row["octave"]
    head = grams.where(octave >= least if least is not None else F.lit(False)).toArrow()
    gram, met, log10 = (head.column(c).to_numpy() for c in ("gram", "met", "log10"))
    order = np.lexsort((gram, -met))
    return context_tree.GramTable.of(gram[order].view(np.uint64), log10[order])


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _digested(model, head):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, (known, logs), memo = model.value, head.value, WordHashes()
        for batch in batches:
            texts = _lowered(batch)
            for part in chunks_of([len(t) for t in texts], _CHUNK_BYTES):
                own = texts[part.start : part.stop]
                tokens = [_tokens(memo, t) for t in own]
                sizes = np.array([len(t) for t in tokens])
                flat, starts = np.concatenate(tokens), np.concatenate(([0], np.cumsum(sizes)[:-1]))
                at = np.minimum(np.searchsorted(known, flat), max(0, len(known) - 1))
                hit = known[at] == flat if len(known) else np.zeros(len(flat), bool)
                gain = np.where(hit, logs[at], 0.0) if len(known) else np.zeros(len(flat))
                n_hit = np.add.reduceat(hit.astype(np.int64), starts)
                codes = context_tree.grams_of(own, DEPTH)
                lengths = np.array([len(t) + 1 for t in own])
                places = np.concatenate(([0], np.cumsum(lengths)[:-1]))
                score, scored = grams.find(codes)
                n_scored = np.add.reduceat(scored.astype(np.int64), places)
                rows = slice(part.start, part.stop)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c)[rows] for c in ("doc_id", "held_out")],
                        pa.array(sizes, pa.int64()),
                        pa.array(n_hit),
                        pa.array(np.add.reduceat(gain, starts)),
                        pa.array(np.add.reduceat(score, places)),
                        pa.array(lengths, pa.int64()),
                        _lists(flat[~hit], sizes - n_hit),
                        _lists(codes[~scored], lengths - n_scored),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_head", "head_score", "score", "n_bytes", "rest", "rest_grams"],
                )

    return run


def score(docs: DataFrame, held_out: str = "held_out") -> DataFrame:
    """Score every whole text; rows whose ``held_out`` is true teach nothing.

    Texts are lower-cased (A-Z). ``score`` is the log10 probability of the text's bytes and its end under the
    context trees, ``bits_per_byte`` the code length that it means. At most 2^21 frequent grams are broadcast with
    their probabilities; the other places of a text are shuffled and joined with the table of all grams. ``base_score`` sums
    log10((c + 1) / (N + V + 1)) over words and one end token. Words are known by 64-bit hashes. The counts of
    at most 2^20 frequent ones are broadcast; the others are shuffled and joined, so no count is left out.

    NULL texts are empty: one end token; NULL flags count as false; rows may repeat; an empty table gives no
    rows. Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.
    """
    spark = docs.sparkSession
    texts = in_small_batches(docs).select("doc_id", "text", F.coalesce(F.col(held_out), F.lit(False)).alias("held_out"))
    train = texts.where("not held_out")
    grams = fit_grams(texts.select("text", "held_out"))
    model = spark.sparkContext.broadcast(head_of(grams))
    counted = train.select("text", "held_out").mapInArrow(_counted(_token_values, "token"), "token long, n long")
    tokens = materialize(counted.groupBy("token").agg(F.sum("n").alias("n")), "token-counts")
    total, distinct = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    least = max(1, -(-total // HEAD_TOKENS))  # no more than HEAD_TOKENS tokens can have this count
    frequent = tokens.where(F.col("n") >= least).toArrow()
    known = frequent.column("token").to_numpy().view(np.uint64)
    order = np.argsort(known)
    logs = np.log10(frequent.column("n").to_numpy() + 1.0)
    head = spark.sparkContext.broadcast((known[order], logs[order]))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    digest = texts.mapInArrow(
        _digested(model, head),
        f"doc_id {id_type}, held_out boolean, n_tokens long, n_head long, head_score double, score double, "
        "n_bytes long, rest array<long>, rest_grams array<long>",
    )
    digest = materialize(digest.withColumn("row", F.monotonically_increasing_id()), "lm-digest")
    rare = tokens.where(F.col("n") < least)
    rest = (
        digest.select("row", F.explode("rest").alias("token"))
        .join(rare, "token")
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("n_rare"), F.sum(F.log10(F.col("n") + 1.0)).alias("rare_score"))
    )
    rest_score = (
        digest.select("row", F.explode("rest_grams").alias("gram"))
        .join(grams, "gram")
        .groupBy("row")
        .agg(F.sum(F.col("log10").cast("double")).alias("more"))
    )
    slim = digest.drop("rest", "rest_grams").join(rest, "row", "left").join(rest_score, "row", "left")
    score = F.col("score") + F.coalesce("more", F.lit(0.0))
    base = F.col("head_score") + F.coalesce("rare_score", F.lit(0.0)) - F.col("n_tokens") * math.log10(total + distinct + 1)
    return slim.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        score.alias("score"),
        (-score / (F.col("n_bytes") * math.log10(2))).alias("bits_per_byte"),
    )
