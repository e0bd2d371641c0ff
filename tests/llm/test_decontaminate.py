"""Copies of benchmark items in whatever company."""

from __future__ import annotations

import random

import numpy as np

from clickloom.llm.decontaminate import best_alignment, contaminated, rare_grams, size_class


def plain_score(text: list, item: list) -> int:
    """Smith-Waterman cell by cell: match 2, anything else -1."""
    best, above = 0, [0] * (len(text) + 1)
    for word in item:
        row = [0]
        for j, other in enumerate(text):
            row.append(max(0, above[j] + (2 if word == other else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best


def brute_force(texts: list[tuple[int, str]], items: list[tuple[int, str]]) -> dict[tuple[int, int], float]:
    """Every text aligned with every item."""
    scores = {}
    for doc_id, text in texts:
        for item_id, item in items:
            words = item.split()
            if (score := plain_score(text.split(), words) / (2 * len(words))) >= 0.5:
                scores[doc_id, item_id] = score
    return scores


def found(spark, texts, items) -> dict[tuple[int, int], float]:
    rows = contaminated(
        spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert len({(r["doc_id"], r["item_id"]) for r in rows}) == len(rows)
    return {(r["doc_id"], r["item_id"]): r["score"] for r in rows}


def test_edited_copy_beside_verbatim_ones(spark):
    item = [f"word{i}" for i in range(24)]
    edited = [f"other{i}" if i % 8 == 4 else w for i, w in enumerate(item)]
    texts = [(i, f"before {' '.join(item)} after") for i in range(1, 6)]
    texts += [(6, f"before {' '.join(edited)} after"), (7, " ".join([*item[:6], "and", "nothing", "else"]))]
    scores = found(spark, texts, [(1, " ".join(item))])
    assert scores == {**{(i, 1): 1.0 for i in range(1, 6)}, (6, 1): (2 * 21 - 3) / 48}


def test_every_fourth_word_changed(spark):
    item = [f"word{i}" for i in range(24)]
    edited = [f"other{i}" if i % 4 == 3 else w for i, w in enumerate(item)]
    scores = found(spark, [(1, " ".join(edited))], [(1, " ".join(item))])
    assert scores == {(1, 1): (2 * 18 - 5) / 48}


def test_alignment_is_smith_waterman():
    rng = random.Random(5)
    for _ in range(200):
        text, item = ([rng.randrange(6) for _ in range(rng.randrange(0, 30))] for _ in range(2))
        if item:
            assert best_alignment(np.array(text, np.int64), np.array(item))[0] == plain_score(text, item)


def test_recall_against_all_alignments(spark):
    """Random edits of items of all sizes, some with a phrase of every text: at least 0.9 of all true pairs."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    phrase = "as everybody knows by now".split()
    items = [[*phrase[: 5 * (i % 2)], *rng.choices(words, k=rng.choice([9, 14, 25, 70]))] for i in range(20)]
    texts = []
    for i in range(160):
        copy = []
        for word in rng.choice(items):
            kind = rng.random()
            if kind < 0.12:
                copy.append(rng.choice(words))
            elif kind < 0.2:
                copy += [word, rng.choice(words)]
            elif kind < 0.26:
                continue
            else:
                copy.append(word)
        if i % 5 == 0:
            copy = copy[: len(copy) // 3]
        texts.append((i, " ".join([*rng.choices(words, k=30), *phrase, *copy, *rng.choices(words, k=30)])))
    items = [(i, " ".join(w)) for i, w in enumerate(items)]
    want, got = brute_force(texts, items), found(spark, texts, items)
    assert got.items() <= want.items()
    assert len(want) > 60 and len(got) >= 0.95 * len(want)


def test_a_phrase_of_all_texts_is_no_seed():
    gram = np.arange(20)
    common = np.where(gram < 5, 4000, 1)
    assert rare_grams(gram, common).tolist() == list(range(5, 20))
    # Copies raise the counts of all n-grams of an item alike: they stay seeds.
    assert rare_grams(gram, np.full(20, 4000)).tolist() == gram.tolist()
    # Words of common n-grams never make up half of an item.
    assert len(rare_grams(gram, np.where(gram < 9, 4000, 1))) == 20 - 8
    assert rare_grams(np.array([3, 3, 3]), np.array([0, 0, 0])).tolist() == [3]


def test_size_classes():
    assert [size_class(n) for n in (0, 1, 7, 8, 63, 64, 511, 512)] == [0, 0, 0, 1, 1, 2, 2, 3]
