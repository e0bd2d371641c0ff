"""The prefix trie of conversations (op 13), built from adaptive radix trees over turn ids.

A turn is known by an id of 16 bytes, so a conversation is a byte string whose turn boundaries lie at multiples
of 16. Conversations with the same string are one key with a count. Keys are sorted over the whole table; every
task cuts its range into runs of bounded size and puts each run into an adaptive radix tree, whose branches
stand for the nodes of the trie: a branch covers the turn-aligned depths on its compressed path, and its keys
are consecutive. All figures of a node are sums over consecutive keys, once each key knows what it shares with
the one before and after it, also across runs. So a node met by several runs (only those on the path of a
run's first or last key) is the sum of its parts, and no group of conversations has to be in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.llm.common import WORD_PATTERN
from clickloom.llm.radix_tree import RadixTree, shared
from clickloom.session import materialize

WIDTH = 16  # bytes of a turn id
FAMILY = 20  # conversations c - c % FAMILY lend their first turns
LENT = 4  # crc32 of the id modulo this is how many
RUN_BYTES = 8 << 20  # keys of one radix tree
RUN_KEYS = 100_000
LIST_BYTES = 64 << 10  # ids of a long list that are hashed at once
TURN_BUCKET = 1024
PART, TAG = "__part", "__tag"
FOUND = (
    "node binary, depth long, open boolean, conv_id long, parent binary, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long"
)


def turn_id() -> Column:
    """32 hexadecimal digits for role and text; the length of the role keeps the two apart."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): every conversation's turns (id, words) after its first ones are replaced.

    The first h = crc32(conv_id as text) % 4 turns come from conversation c - c % 20: all it has if fewer, none
    if it is absent. Turns are ordered by ``turn``, NULL first, equal ones by turn id. Rows without a conv_id
    belong to no conversation. A conversation's turns are gathered by stretches of turn numbers first; together
    they must fit in a row (40 bytes a turn).
    """
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD_PATTERN))
    turns = conversations.where("conv_id is not null").select(
        "conv_id", "turn", turn_id().alias("id"), words.alias("words")
    )
    bucket = F.floor(F.col("turn") / TURN_BUCKET).alias("bucket")
    stretches = turns.groupBy("conv_id", bucket).agg(F.sort_array(F.collect_list(F.struct("turn", "id", "words"))).alias("t"))
    whole = stretches.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("bucket", "t"))).alias("s"))
    in_order = F.flatten(F.transform("s", lambda s: s["t"]))
    own = materialize(
        whole.select("conv_id", F.transform(in_order, lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns")),
        "conversations",
    )
    lent = F.crc32(F.col("conv_id").cast("string").cast("binary")) % LENT
    kept = own.withColumns({"h": lent.cast("int"), "from": F.col("conv_id") - F.col("conv_id") % FAMILY})
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("from"), F.slice("turns", 1, LENT - 1).alias("head")
    )
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return kept.join(heads, "from", "left").select("conv_id", F.concat(head, rest).alias("turns"))


def _run_nodes(before: bytes | None, keys: list[bytes], words: list, counts: list[int], firsts: list[int], after: bytes | None):
    """Rows of FOUND for one run of consecutive keys, given the keys beside it."""
    tree = RadixTree()
    for key in keys:
        tree.add(key)

    def shared_turns(a, b):
        return -1 if a is None or b is None else shared(a, b, 0, min(len(a), len(b))) // WIDTH

    n = len(keys)
    around = [before, *keys, after]
    common = np.array([shared_turns(around[i], around[i + 1]) for i in range(n + 1)])  # with the key before
    length = np.array([len(k) // WIDTH for k in keys])
    totals = [np.concatenate([[0], np.cumsum(np.asarray(w, np.int64))]) for w in words]  # words of the first d turns
    repeats = np.array(counts) - 1
    leaf = common[1:] < length
    with_before = np.array([totals[i][max(common[i], 0)] for i in range(n)])

    def upto(x):
        return np.concatenate([[0], np.cumsum(x)])

    members, extra, leaves = upto(repeats + 1), upto(repeats), upto(leaf)
    whole, joined = upto(repeats * np.array([t[-1] for t in totals])), upto(with_before)
    least = np.array(firsts)

    order = list(tree.preorder())
    sizes: dict[int, int] = {}
    for node, _ in reversed(order):
        sizes[id(node)] = (node.ends is not None) + sum(sizes[id(c)] for c in node.children())
    offered = 0
    deepest = {}  # branch -> (id, smallest member, is open) of the deepest node at or above its depth
    for node, above in order:
        if above is None:
            at, up = 0, None
        else:
            at, up = above.depth // WIDTH + 1, deepest[id(above)]
        low = offered  # preorder meets branches in the order of their keys
        offered += node.ends is not None
        high = low + sizes[id(node)]
        smallest = int(least[low:high].min())
        key, depth = keys[low], node.depth // WIDTH
        path = hashlib.md5(key[: (at - 1) * WIDTH] if at else b"", usedforsecurity=False)
        own = totals[low]
        for d in range(at, depth + 1):
            if d:
                path.update(key[(d - 1) * WIDTH : d * WIDTH])
            shares_before, shares_after = low == 0 and common[0] >= d, high == n and common[n] >= d
            is_open = bool(shares_before or shares_after)
            start = low if shares_before else low + 1  # keys whose common part with the one before is inside
            if d < depth or d * WIDTH < node.depth:
                children = int(common[low] <= d)
            else:
                children = int(((common[low:high] <= d) & (length[low:high] > d)).sum())
            above_words = int(own[d - 1]) if d else 0
            shared_keys = int(extra[high] - extra[low]) + high - start
            saved = int(whole[high] - whole[low] + joined[high] - joined[start]) - above_words * shared_keys
            digest = path.digest()
            yield (
                digest, d, is_open, smallest, up[0] if up and up[2] else None, up[1] if up and not up[2] else None,
                int(members[high] - members[low]), children, int(leaves[high] - leaves[low]), saved,
            )
            up = digest, smallest, is_open
        deepest[id(node)] = up


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in FOUND.split(", ")]
    types = {"binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_()}
    schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in FOUND.split(", ")])
    rows: list[tuple] = []

    def written():
        columns = list(zip(*rows))
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], names=names)
        rows.clear()
        return out

    def run(before, keys, after):
        for row in _run_nodes(before, [k[0] for k in keys], *[[k[i] for k in keys] for i in (1, 2, 3)], after):
            rows.append(row)
            if len(rows) >= 10_000:
                yield written()

    part, before, keys, size = None, None, [], 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (PART, "key", "words", "n", "first", TAG)]
        for now, key, words, n, conv, tag in zip(*columns):
            if now != part:
                if keys:
                    yield from run(before, keys, None)
                part, before, keys, size = now, None, [], 0
            if tag < 0:
                before = key
            elif tag > 0:
                if keys:
                    yield from run(before, keys, key)
                before, keys, size = key, [], 0
            else:
                if len(keys) >= RUN_KEYS or (keys and size + len(key) > RUN_BYTES):
                    yield from run(before, keys, key)
                    before, keys, size = keys[-1][0], [], 0
                keys.append((key, words, n, conv))
                size += len(key)
    if keys:
        yield from run(before, keys, None)
    if rows:
        yield written()


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the comma-joined ids of a node, at most LIST_BYTES long; rows come by node and id."""
    node, first, ids, size = None, 0, [], 0

    def piece():
        return pa.RecordBatch.from_pydict({"node": [node], "first": [first], "ids": [",".join(ids)]})

    for batch in batches:
        for now, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (now != node or size >= LIST_BYTES):
                yield piece()
                ids, size = [], 0
            if not ids:
                node, first = now, conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if ids:
        yield piece()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined pieces of each node; rows come by node and first id."""
    node = state = None

    def done():
        return pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [state.hexdigest()]})

    for batch in batches:
        for now, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if state is not None and now == node:
                state.update(b",")
            else:
                if state is not None:
                    yield done()
                node, state = now, hashlib.sha256()
            state.update(ids.encode())
    if state is not None:
        yield done()


def ends(members: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id): a node with a long list is spread by a range sort, its pieces are hashed in order."""
    laid = members.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = laid.mapInArrow(_lists, "node binary, first long, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_hashed, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per trie node of ``conversations`` (conv_id, turn, role, text), see the module.

    Columns: conv_id (the smallest member), depth, parent_conv_id (NULL for the root), n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. Role and text of NULL are empty; repeated rows are repeated turns; no
    conversation, no node. Other columns are ignored.
    """
    ids = F.transform("turns", lambda t: t["id"])
    members = materialize(
        rebuilt(conversations).select(
            "conv_id",
            F.unhex(F.array_join(ids, "")).alias("key"),
            F.transform("turns", lambda t: t["words"]).alias("words"),
        ),
        "members",
    )
    keys = members.groupBy("key").agg(
        F.first("words").alias("words"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first")
    )
    laid = materialize(keys.repartitionByRange("key").withColumn(PART, F.spark_partition_id()), "keys")
    # The keys beside each range: one row per partition.
    beside = Window.orderBy(PART)
    bounds = laid.groupBy(PART).agg(F.min("key").alias("low"), F.max("key").alias("high"))
    bounds = bounds.select(PART, F.lag("high").over(beside).alias("before"), F.lead("low").over(beside).alias("after"))
    guards = bounds.select(PART, F.explode(F.array(F.struct(F.col("before").alias("key"), F.lit(-1).alias(TAG)), F.struct(F.col("after").alias("key"), F.lit(1).alias(TAG)))).alias("g"))
    guards = guards.where("g.key is not null").select(PART, "g.*")
    rows = laid.withColumn(TAG, F.lit(0)).unionByName(guards, allowMissingColumns=True)
    found = materialize(
        rows.select(PART, "key", "words", "n", "first", TAG)
        .repartition(PART)
        .sortWithinPartitions(PART, "key")
        .mapInArrow(_nodes, FOUND),
        "nodes",
    )
    shared_nodes = materialize(
        found.where("open")
        .groupBy("node")
        .agg(
            F.first("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            F.first("parent").alias("parent"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        ),
        "shared-nodes",
    )
    every = found.where("not open").drop("open").unionByName(shared_nodes, allowMissingColumns=True)
    # A node without a parent to look up meets nobody under its own id.
    above = shared_nodes.select(F.col("node").alias("above"), F.col("conv_id").alias("above_conv_id"))
    named = every.join(above, F.coalesce("parent", "node") == F.col("above"), "left")
    up = F.coalesce("parent_conv_id", F.when(F.col("parent").isNotNull(), F.col("above_conv_id")))
    ended = ends(members.select(F.unhex(F.md5("key")).alias("node"), "conv_id"))
    return named.join(ended, "node", "left").select(
        "conv_id",
        "depth",
        up.alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
