"""Context-tree scores against the recursion of their definition."""

from collections import Counter
from functools import cache
from math import exp, lgamma, log

import numpy as np
import pytest

from clickloom.llm import context_tree, lm_score

DEPTH = lm_score.DEPTH
END = context_tree.END
TRAIN = ["abracadabra", "Abba banana band", "", None, "naïve café \n the cat", "the cat the cat the cat", "the cat the cat the cat"]
OTHERS = ["the bat", "zebra ☃", "", None, "abracadabra the cat the band"]


def contexts_of(text):
    padded = bytes([END]) * DEPTH + (text or "").encode().lower() + bytes([END])
    return [(padded[i - DEPTH : i], padded[i]) for i in range(DEPTH, len(padded))]


def definition(texts):
    """log10 probability of a text: one tree of contexts for every node of a byte's binary decomposition."""
    counts = Counter()  # (context, node, bit)
    for text in texts:
        for context, byte in contexts_of(text):
            for step in range(8):
                node, bit = 1 << step | byte >> 8 - step, byte >> 7 - step & 1
                for d in range(DEPTH + 1):
                    counts[context[DEPTH - d :], node, bit] += 1
    nodes = {(context, node) for context, node, _ in counts}
    children = {}
    for context, node in nodes:
        if context:
            children.setdefault((context[1:], node), []).append(context)

    def kt(context, node):
        zeros, ones = counts[context, node, 0], counts[context, node, 1]
        return lgamma(zeros + 0.5) + lgamma(ones + 0.5) - lgamma(zeros + ones + 1) - 2 * lgamma(0.5)

    @cache
    def below(context, node):
        return sum(weight(c, node) for c in children.get((context, node), ()))

    @cache
    def weight(context, node):
        own = kt(context, node)
        return own if len(context) == DEPTH else np.logaddexp(own, below(context, node)) - log(2)

    def probability_of_one(context, node):
        done, left, edge = 0.0, 1.0, 0.5
        for d in range(DEPTH + 1):
            now = context[DEPTH - d :]
            if (now, node) not in nodes:
                break
            zeros, ones = counts[now, node, 0], counts[now, node, 1]
            guess = (ones + 0.5) / (zeros + ones + 1)
            edge = done + left * guess
            share = 1 / (1 + exp(below(now, node) - kt(now, node))) if d < DEPTH else 1
            done, left = done + left * share * guess, left * (1 - share)
        return edge

    def score(text):
        total = 0.0
        for context, byte in contexts_of(text):
            for step in range(8):
                one = probability_of_one(context, 1 << step | byte >> 8 - step)
                total += log(one if byte >> 7 - step & 1 else 1 - one)
        return total / log(10)

    return score


@pytest.mark.parametrize("head", [0, 30, 1 << 21])
def test_scores_by_definition(spark, monkeypatch, head):
    """Whatever share of the grams is broadcast, the scores are those of all contexts."""
    monkeypatch.setattr(lm_score, "HEAD_GRAMS", head)
    rows = [(i, t, i >= len(TRAIN)) for i, t in enumerate(TRAIN + OTHERS)]
    got = lm_score.score(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")).collect()
    score = definition(TRAIN)
    assert len(got) == len(rows)
    for r in got:
        assert r["score"] == pytest.approx(score(rows[r["doc_id"]][1]), rel=1e-5)


def test_predictions_of_a_context_sum_to_one(spark):
    """All next bytes after a context, most of them never met."""
    taught = [(t, False) for t in TRAIN]
    asked = [("\nThe ca"[:6], True)]
    grams = lm_score.fit_grams(spark.createDataFrame(taught + asked, "text string, held_out boolean"))
    known = {r["gram"]: r["n"] for r in grams.select("gram", grams["met"].alias("n")).collect()}
    assert sum(known.values()) == sum(len(contexts_of(t)) for t, _ in taught + asked)
    code = np.array([int.from_bytes(b"the c", "big") << 8 | b for b in range(256)], np.uint64)
    total = np.zeros(256)
    for step in range(8):
        where, levels, _ = context_tree.climb(code, np.arange(256), step, DEPTH, 1)
        state = [np.full(len(levels[-1].key), x) for x in (0.0, 1.0, 0.5)]
        one = context_tree.descend(levels, *state)[where]
        total += np.log(np.where(context_tree.one_bits(code, step), one, 1 - one))
    assert np.exp(total).sum() == pytest.approx(1)


def test_slots_that_collide():
    keys = np.arange(1, 5000, dtype=np.uint64)
    table = context_tree.GramTable.of(keys, -np.arange(1, 5000, dtype=np.float32))
    value, held = table.find(np.concatenate([keys, keys + np.uint64(10**6)]))
    assert not held[len(keys) :].any() and held[: len(keys)].mean() > 0.9
    assert held[0] and np.array_equal(value[: len(keys)][held[: len(keys)]], -keys[held[: len(keys)]].astype(float))


def test_blocks_hold_whole_groups(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(lm_score, "_BLOCK_ROWS", 5)
    group = np.repeat([1, 2, 3, 9], [3, 8, 1, 4])
    batches = [pa.RecordBatch.from_arrays([pa.array(group[i : i + 2]), pa.array(np.arange(i, i + 2))], ["g", "n"]) for i in range(0, 16, 2)]
    blocks = list(lm_score._blocks(iter(batches)))
    assert np.concatenate([b[1] for b in blocks]).tolist() == list(range(16))
    assert len(blocks) > 1 and sum(len(set(b[0])) for b in blocks) == 4
