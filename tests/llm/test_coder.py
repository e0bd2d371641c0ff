from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from clickloom.llm import bloom, context_tree, id_coder
from clickloom.llm.packing import Bins, pack_group

ids = st.one_of(
    st.lists(st.integers(0, 3), max_size=300),
    st.lists(st.integers(0, 50_256), max_size=60),
    st.lists(st.integers(0, 2**32 - 1), max_size=60),
)


@settings(max_examples=60, deadline=None)
@given(st.lists(ids, max_size=6))
def test_ids_round_trip(blocks):
    arrays = [np.array(b, np.uint32) for b in blocks]
    decoded = id_coder.decode(id_coder.encode(arrays))
    assert [a.tolist() for a in decoded] == blocks


def test_a_long_block_round_trips():
    """Enough words for carries that run over several of them, and for frequencies to be halved."""
    rng = np.random.default_rng(5)
    block = np.minimum(rng.geometric(0.01, 40_000), 50_000).astype(np.uint32)
    (again,) = id_coder.decode(id_coder.encode([block]))
    assert (again == block).all()


def test_predictable_ids_take_little_room():
    (coded,) = id_coder.encode([np.tile(np.arange(40_000, 40_050, dtype=np.uint32), 80)])
    assert len(coded) * 8 / 4000 < 1.5


def test_frequent_ids_take_less_room():
    """Ids that no id before them foretells: 8.5 bits each by their frequencies."""
    rng = np.random.default_rng(3)
    share = 1 / np.arange(1, 3001)
    block = rng.permutation(50_000)[rng.choice(3000, 60_000, p=share / share.sum())].astype(np.uint32)
    (coded,) = id_coder.encode([block])
    assert (id_coder.decode([coded])[0] == block).all()
    assert len(coded) * 8 / len(block) < 11


def test_blocks_are_independent():
    a, b = np.arange(500, dtype=np.uint32), np.full(900, 7, np.uint32)
    alone = id_coder.encode([a])[0]
    together = id_coder.encode([a, b])
    assert [x.tolist() for x in id_coder.decode([together[1], alone])] == [b.tolist(), a.tolist()]


def test_damage_is_found():
    (coded,) = id_coder.encode([np.arange(300, dtype=np.uint32)])
    for broken in (coded[:-4], b"XXXX" + coded[4:], coded[:40] + bytes([coded[40] ^ 1]) + coded[41:]):
        with pytest.raises(ValueError):
            id_coder.decode([broken])


def test_grams_stay_inside_texts():
    code = context_tree.grams_of([b"ab", b"", b"c"], 2)
    windows = [b"\xff\xffa", b"\xffab", b"ab\xff", b"\xff\xff\xff", b"\xff\xffc", b"\xffc\xff"]
    assert code.tolist() == [int.from_bytes(w, "big") for w in windows]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=200), st.integers(0, 3))
def test_bloom_has_no_false_negatives(values, power):
    segments = 1 << power
    at = bloom.positions(np.array(values, np.uint64), segments)
    bits = bloom.empty(segments)
    bloom.insert(bits, at)
    assert bloom.found(bits, at).all()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 25), st.integers(-1, 3), st.integers(0, 2)), max_size=60))
def test_best_fit_against_a_scan_of_all_bins(items):
    capacity, bins = 25, Bins(25)
    plain: list[list] = []
    for size, source, cluster in items:
        bit = 1 << cluster if cluster else 0
        fits = [
            (capacity - sum(x[0] for x in own), i)
            for i, own in enumerate(plain)
            if sum(x[0] for x in own) + size <= capacity
            and not any((source >= 0 and x[1] == source) or x[2] & bit for x in own)
        ]
        room, chosen = min(fits, default=(capacity, len(plain)))
        if chosen == len(plain):
            plain.append([])
        plain[chosen].append((size, source, bit))
        assert bins.place(size, source, bit) == (chosen, room)


def test_long_items_are_cut():
    import pandas as pd

    items = pd.DataFrame({"size": [25, 10], "source": ["a", "a"], "cluster": [None, None]})
    got = sorted(pack_group(items, 10))
    assert got == [(0, 0, 1, 0, 10), (0, 1, 2, 0, 10), (0, 2, 0, 0, 5), (1, 0, 3, 0, 10)]
