"""Near-duplicate groups by an LSH forest over MinHash signatures."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.common import chunks_of, in_small_batches, mixed, texts_in
from clickloom.llm.components import components
from clickloom.llm.shingles import WordHashes, shingle_set
from clickloom.session import materialize

SHINGLE_WORDS = 5
PERCENT = 75
TREES, STEP = 20, 4
HASHES = TREES * STEP
DEPTHS = (4, 6, 8, 12, 20, 40, 80)
CROWD = 2048
CROWD_SHINGLES = 4_000_000
# Signature agreement that a pair at the similarity limit misses with a probability of about 1e-5.
LIKELY = 44
BROADCAST_IDS = 1_000_000
_CHUNK = 1 << 17
_MULTIPLIERS = mixed(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values of non-empty shingle sets, 32 bits of each; shape (sets, HASHES)."""
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    flat = np.concatenate(sets)
    out = np.empty((len(sets), HASHES), np.uint64)
    for k, factor in enumerate(_MULTIPLIERS):
        out[:, k] = np.minimum.reduceat(flat * factor, starts)
    return (mixed(out) >> np.uint64(32)).astype(np.uint32)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set size, set identity and signature of every text."""
    memo = WordHashes()
    for batch in batches:
        ids, texts = batch.column("doc_id"), texts_in(batch)
        for part in chunks_of([len(t) // 6 for t in texts], _CHUNK):
            sets = [shingle_set(memo.of(texts[i]), SHINGLE_WORDS) for i in part]
            full = [s for s in sets if len(s)]
            rows = iter(signatures(full) if full else ())
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            values = [next(rows).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(part.start, len(part)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(values, pa.binary()),
                ],
                ["doc_id", "n_shingles", "set_key", "signature"],
            )


def prefixes(signature: np.ndarray, tree: int, depth: int) -> np.ndarray:
    """A key of the first ``depth`` values in the order of a tree, which starts at its own values and goes
    round; the low bits name the tree."""
    h = np.full(len(signature), depth * TREES + tree, np.uint64)
    for i in range(depth):
        h = (h ^ signature[:, (tree * STEP + i) % HASHES].astype(np.uint64)) * _BASE
        h ^= h >> np.uint64(29)
    return (mixed(h) & ~np.uint64(31) | np.uint64(tree)).view(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            signature = _matrix(batch.column("signature"))
            for tree in range(TREES):
                key = pa.array(prefixes(signature, tree, DEPTHS[0]))
                yield pa.RecordBatch.from_arrays([key, batch.column("rep")], ["key", "rep"])


def _deeper(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = batch.column("key").to_numpy() & 31
            signature, key = _matrix(batch.column("signature")), np.empty(batch.num_rows, np.int64)
            for tree in np.unique(trees):
                own = trees == tree
                key[own] = prefixes(signature[own], int(tree), depth)
            names = ["rep", "comp", "signature", "n_shingles"]
            yield pa.RecordBatch.from_arrays([pa.array(key), *map(batch.column, names)], ["key", *names])

    return run


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


def linking_pairs(
    signature: np.ndarray, comp: np.ndarray, sets: list[np.ndarray], tree: int | None, second: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all components which any similar pair with well-agreeing signatures joins.

    Components grow with every link, so there are fewer links than members. With ``tree``, pairs that also
    share an earlier tree's bucket are left to that. With ``second``, the members before that position are
    compared with those from it on and with no others.
    """
    a, b = [], []
    low, root, size = signature.astype(np.uint8), comp.copy(), np.array([len(s) for s in sets])
    for i in range(second or len(low) - 1):
        rest = slice(second or i + 1, None)
        near = ((low[rest] == low[i]).sum(axis=1) >= LIKELY) & (root[rest] != root[i])
        near &= 100 * np.minimum(size[rest], size[i]) >= PERCENT * np.maximum(size[rest], size[i])
        at = np.flatnonzero(near) + rest.start
        if tree is not None and len(at):
            shared = (signature[at] == signature[i]).reshape(len(at), TREES, STEP).all(axis=2)
            at = at[shared.argmax(axis=1) == tree]
        for j in at.tolist():
            if root[j] != root[i] and similar(sets[i], sets[j]):
                a.append(i)
                b.append(j)
                root[root == root[j]] = root[i]
    return np.array(a, np.int64), np.array(b, np.int64)


def spanning_pairs(low: np.ndarray, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges between components of a spanning tree that joins the best-agreeing signatures first.

    Members of one component count as joined, so there are fewer edges than components; those below the
    likely agreement are left out.
    """
    a, b = [], []
    best, via = np.full(len(low), -1), np.zeros(len(low), np.int64)
    inside, at = np.zeros(len(low), bool), 0
    for _ in range(len(low) - 1):
        inside[at] = True
        agree = np.where(comp == comp[at], HASHES + 1, (low == low[at]).sum(axis=1))
        nearer = agree > best
        best[nearer], via[nearer] = agree[nearer], at
        at = int(np.where(inside, -1, best).argmax())
        if LIKELY <= best[at] <= HASHES and comp[via[at]] != comp[at]:
            a.append(via[at])
            b.append(at)
    return np.array(a, np.int64), np.array(b, np.int64)


def _in_buckets(choose):
    """key, a, b of the pairs that ``choose`` picks in each bucket; rows come by key."""

    def pairs_of(table: pa.Table, buckets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, rep, comp = (table[c].to_numpy() for c in ("key", "rep", "comp"))
        signature = _matrix(table["signature"].combine_chunks())
        sets = table["shingles"].to_pylist() if "shingles" in table.column_names else None
        side = table["side"].to_numpy() if "side" in table.column_names else None
        for own in buckets:
            second = ()
            if side is not None:
                own = own[np.argsort(side[own], kind="stable")]
                second = (int((side[own] == 0).sum()) if side[own[-1]] else 0,)
            if sets is None:
                a, b = choose(signature[own].astype(np.uint8), comp[own])
            else:
                texts = [np.frombuffer(sets[i], np.uint64) for i in own]
                a, b = choose(signature[own], comp[own], texts, int(key[own[0]]) & 31, *second)
            if len(a):
                columns = np.full(len(a), key[own[0]]), rep[own[a]], rep[own[b]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            key = rest["key"].to_numpy()
            if len(key) and key[0] == key[-1]:
                continue
            *whole, last = np.split(np.arange(len(key)), np.flatnonzero(np.diff(key)) + 1)
            yield from pairs_of(rest, whole)
            rest = rest.slice(int(last[0]))
        if rest is not None and len(rest):
            yield from pairs_of(rest, [np.arange(len(rest))])

    return run


def _picked(rows: DataFrame, choose) -> DataFrame:
    found = rows.repartition("key").sortWithinPartitions("key").mapInArrow(
        _in_buckets(choose), "key long, a long, b long"
    )
    return found.select("key", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = WordHashes()
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            values = [shingle_set(memo.of(t), SHINGLE_WORDS).tobytes() for t in texts_in(part)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values, pa.binary())], ["id", "shingles"])


def _similar(a: pa.Array, b: pa.Array) -> pa.Array:
    pairs = ([np.frombuffer(v.as_buffer(), np.uint64) for v in pair] for pair in zip(a, b))
    return pa.array([similar(x, y) for x, y in pairs], pa.bool_())


def _shingle_sets(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """id and shingles of the documents that ``ids`` names, read from their texts."""
    ids = materialize(ids.distinct(), "wanted-ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = docs.join(wanted, docs["doc_id"] == wanted["id"], "left_semi").dropDuplicates(["doc_id"])
    return materialize(texts.mapInArrow(_sets, "id long, shingles binary"), "shingle-sets")


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of document ids that are similar as whole shingle sets."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    sets = _shingle_sets(ids, docs)
    first, second = (sets.select(F.col("id").alias(s), F.col("shingles").alias(f"set_{s}")) for s in "ab")
    alike = F.arrow_udf(_similar, "boolean")
    return pairs.join(first, "a").join(second, "b").where(alike("set_a", "set_b")).select("a", "b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Group documents whose sets of 5-word shingles have a Jaccard similarity of 0.75 or more.

    Words are lower-cased (A-Z) and split at ASCII white space; a shorter text is one shingle, a text without
    words is linked with nothing. Documents with equal sets form a class, and only class representatives go on.

    The forest orders signatures in 20 ways, each starting at another four values. Documents that agree in a
    tree's first four values share a bucket; first each is compared with one bucket's smallest member, which
    binds groups of copies of any size by a star. Buckets that still hold several components are searched for
    pairs of different components with well-agreeing signatures: first for the edges of a spanning tree, fewer
    than the bucket has members; then, where components are left apart, all such pairs are compared inside the
    bucket, which gives out only links. Buckets with more than 2048 members or 4 million shingles are first parted
    by longer prefixes, as deep as the region needs, and all their members are compared with the smallest one too,
    which joins most of what they hold; where components are left apart, the bucket is cut into blocks, and every
    two blocks are searched for such pairs by a task of their own. Every pair found is confirmed on whole sets. A pair at similarity 0.75 shares a bucket with
    probability 0.9995, one at 0.85 with 1 - 3e-7.

    Rows without an id are linked with nothing. Rows that share an id are one document. Other columns are not
    read; an empty table gives no rows. Returns doc_id, n_shingles, component_id, kept.
    """
    docs = in_small_batches(docs).select("doc_id", "text")
    digest = materialize(
        docs.mapInArrow(_digest, "doc_id long, n_shingles long, set_key binary, signature binary"), "signatures"
    )
    named = digest.where("set_key is not null and doc_id is not null")
    classes = materialize(named.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "classes")
    reps = materialize(
        named.join(classes, (named["set_key"] == classes["set_key"]) & (named["doc_id"] == classes["rep"]))
        .select("rep", "signature", "n_shingles")
        .dropDuplicates(["rep"]),
        "representatives",
    )
    # Buckets with one member are of no further use.
    rooted = materialize(reps.select("rep", "signature").mapInArrow(_rooted, "key long, rep long"), "buckets")
    leaders = materialize(
        rooted.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader < last"),
        "leaders",
    )
    shared = materialize(rooted.join(leaders.select("key", "leader"), "key"), "shared-buckets")
    stars = materialize(
        shared.where("leader < rep").groupBy(F.col("rep").alias("b")).agg(F.min("leader").alias("a")), "stars"
    )
    roots = components(materialize(_confirmed(stars, docs), "star-links"))

    rows, star, crowd, parted = _open_buckets(shared, reps, roots)
    # The edges of spanning trees join most of what belongs together.
    spans = materialize(_picked(rows, spanning_pairs), "spanning-pairs")
    edges = materialize(spans.select("a", "b").unionByName(star).distinct(), "spanning-edges")
    more = materialize(_confirmed(edges, docs), "spanning-links")
    if not more.isEmpty():
        roots = _joined(roots, more)
    # Where components are left that have likely pairs, all of these are compared inside the bucket.
    apart = _with_roots(rows.drop("comp").join(spans.select("key").distinct(), "key", "left_semi"), roots)
    apart = materialize(_several(apart).drop("members", "leader", "weight"), "buckets-apart")
    sets = _shingle_sets(apart.select(F.col("rep").alias("id")), docs)
    choose = linking_pairs if not parted else (lambda signature, comp, sets, _: linking_pairs(signature, comp, sets, None))
    whole = apart.join(sets, apart["rep"] == sets["id"]).select("key", "rep", "comp", "signature", "shingles")
    more = materialize(_picked(whole, choose).select("a", "b").distinct(), "bucket-links")
    if not more.isEmpty():
        roots = _joined(roots, more)
    if parted:
        crowd = materialize(_several(_with_roots(crowd, roots)).drop("members", "leader", "weight"), "crowds")
        if not crowd.isEmpty():
            roots = _joined(roots, materialize(_crowd_links(crowd, docs), "crowd-links"))

    grouped = classes.join(roots, classes["rep"] == roots["node"], "left").select(
        F.col("set_key").alias("class"), F.coalesce("root", "rep").alias("group_id")
    )
    joined = digest.select("doc_id", "n_shingles", "set_key").join(grouped, F.col("set_key") == F.col("class"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("group_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components that further links make of those known; their stars stand for the links that made them."""
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links))


def _with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    joined = rows.join(roots, rows["rep"] == roots["node"], "left")
    return joined.withColumn("comp", F.coalesce("root", "rep")).drop("node", "root")


def _crowd_links(crowd: DataFrame, docs: DataFrame) -> DataFrame:
    """Links that join all components which likely pairs inside crowded buckets join.

    A bucket is cut into blocks of half a bucket's room. A component that fills a block has blocks of its own,
    which are not compared with each other; every other two blocks of a bucket make a task.
    """
    room, room_shingles = CROWD / 2, CROWD_SHINGLES / 2
    groups = materialize(
        crowd.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("w")),
        "crowd-components",
    )
    large = (F.col("n") > room) | (F.col("w") > room_shingles)
    blocks = F.ceil(F.greatest(F.col("n") / room, F.col("w") / room_shingles))
    own = groups.where(large).select("key", "comp", F.col("comp").alias("whole"), blocks.alias("own"))
    rest = groups.where(~large).groupBy("key").agg(F.sum("n").alias("n"), F.sum("w").alias("w"))
    part = F.pmod(F.xxhash64("rep"), F.coalesce("own", "rest"))
    members = materialize(
        crowd.join(own, ["key", "comp"], "left")
        .join(rest.select("key", blocks.alias("rest")), "key", "left")
        .withColumn("block", F.xxhash64(F.col("whole").isNotNull(), "whole", part))
        .drop("own", "rest"),
        "crowd-blocks",
    )
    named = materialize(members.select("key", "whole", "block").distinct(), "block-names")
    first, second = (named.select("key", F.col("whole").alias(f"whole_{s}"), F.col("block").alias(s)) for s in "ab")
    apart = F.coalesce(F.col("whole_a") != F.col("whole_b"), F.lit(True))
    # The key of two blocks keeps the name of the tree.
    pair = F.xxhash64("key", "a", "b").bitwiseAND(F.lit(~31)).bitwiseOR(F.col("key").bitwiseAND(F.lit(31)))
    pairs = first.join(second, "key").where((F.col("a") <= F.col("b")) & apart).withColumn("pair", pair)
    sides = pairs.select("key", F.col("a").alias("block"), "pair", F.lit(0).alias("side")).unionByName(
        pairs.where("a < b").select("key", F.col("b").alias("block"), "pair", F.lit(1).alias("side"))
    )
    sets = _shingle_sets(members.select(F.col("rep").alias("id")), docs)
    rows = (
        members.join(materialize(sides, "block-pairs"), ["key", "block"])
        .join(sets, members["rep"] == sets["id"])
        .select(F.col("pair").alias("key"), "rep", "comp", "signature", "shingles", "side")
    )
    return _picked(rows, linking_pairs).select("a", "b").distinct()


def _open_buckets(
    shared: DataFrame, reps: DataFrame, roots: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame, bool]:
    """Buckets with several components, parted by longer prefixes where they are crowded; pairs of the crowded
    ones' members with the smallest; the crowded ones as they were; and whether any was parted."""
    wide = ["key", "rep", "comp", "signature", "n_shingles"]
    rows = _several(_with_roots(shared.select("key", "rep").join(reps, "rep"), roots))
    small, star, first, parted, depths = None, None, None, False, iter(DEPTHS[1:])
    while True:
        rows = materialize(rows, "open-buckets")
        crowded = (F.col("members") > CROWD) | (F.col("weight") > CROWD_SHINGLES)
        fine, crowd = rows.where(~crowded), rows.where(crowded)
        edges = crowd.where("rep != leader").select(F.col("leader").alias("a"), F.col("rep").alias("b"))
        first = crowd.select("key", "rep", "signature", "n_shingles") if first is None else first
        small = fine if small is None else small.unionByName(fine)
        star = edges if star is None else star.unionByName(edges)
        depth = next(depths, None)
        if depth is None or crowd.isEmpty():
            return small.select(wide), star, first, parted
        parted = True
        rows = _several(
            crowd.select(wide).mapInArrow(
                _deeper(depth), "key long, rep long, comp long, signature binary, n_shingles long"
            )
        )


def _several(rows: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component, with the bucket's size and smallest member."""
    sizes = (
        rows.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.sum("n_shingles").alias("weight"),
            F.min("rep").alias("leader"),
            F.min("comp").alias("__low"),
            F.max("comp").alias("__high"),
        )
        .where("__low < __high")
        .drop("__low", "__high")
    )
    return rows.join(sizes, "key")
