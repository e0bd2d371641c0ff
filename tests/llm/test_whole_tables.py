"""The registered queries on a whole small table, against SQL or a plain computation."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from clickloom.llm.queries import ORACLE, QUERIES
from compare import difference, duckdb_on
from conftest import SMALL


@pytest.fixture(scope="module")
def documents():
    path = f"{SMALL}/documents.parquet"
    return duckdb.sql(f"select doc_id, text, lang, source from '{path}' order by doc_id").fetchall()


@pytest.fixture(scope="module")
def items():
    return duckdb.sql(f"select item_id, text from '{SMALL}/benchmark.parquet'").fetchall()


def result(spark, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, SMALL).collect()}


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def words(text):
    return (text or "").encode().lower().split()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_statement(spark, name):
    assert difference(QUERIES[name](spark, SMALL), duckdb_on(SMALL), ORACLE[name]) is None


def held(documents, items):
    """Pairs of documents and items whose words stand in them in one piece."""

    def line(text):
        return " " + " ".join(re.findall(r"\w+", text.lower())) + " "

    lines = [(i, line(t)) for i, t in items]
    return {(d, i) for d, t, *_ in documents for i, x in lines if t and x in line(t)}


def test_decontamination(spark, documents, items):
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op1_decontamination"](spark, SMALL).collect()}
    assert got == held(documents, items) and got


def test_decontamination_finds_edited_copies(spark, items):
    from clickloom.llm.decontaminate import contaminated

    rows, expected = [], set()
    for i, text in items[:40]:
        own = text.split()
        if len(own) < 20:
            continue
        for k, edit in enumerate((lambda w: w[:9] + ["changed"] + w[10:], lambda w: w[:7] + w[8:15] + ["new", "words"] + w[15:])):
            rows.append((1000 * k + i, "some words before it " * 8 + " ".join(edit(own)) + " and words after" * 9))
            expected.add((1000 * k + i, i))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected
    assert all(0.5 <= r["score"] < 1 for r in got)


def test_packing(spark, documents):
    got = QUERIES["op2_best_fit_packing"](spark, SMALL).collect()
    source = {d: s for d, _, _, s in documents}
    text = {d: t for d, t, *_ in documents}
    bins, taken = defaultdict(list), Counter()
    for r in got:
        bins[r["bin"]].append(r)
        taken[r["doc_id"]] += r["n_words"]
    assert taken == {d: len(words(t)) + 1 for d, t in text.items()}
    for own in bins.values():
        own.sort(key=lambda r: r["bin_offset"])
        assert [r["bin_offset"] for r in own] == np.cumsum([0] + [r["n_words"] for r in own])[:-1].tolist()
        assert own[-1]["bin_offset"] + own[-1]["n_words"] <= 1024
        assert len({source[r["doc_id"]] for r in own}) == len(own) == len({text[r["doc_id"]] for r in own})


def test_lm_score(spark, documents):
    counts = Counter()
    for d, t, *_ in documents:
        if remainder(d, 7) != 2:
            counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    got = result(spark, "op4_context_tree")
    for d, t, *_ in documents:
        tokens = [*words(t), None]
        r = got[d]
        assert r["held_out"] == (remainder(d, 7) == 2)
        assert (r["n_tokens"], r["train_tokens"]) == (len(tokens), n)
        assert r["n_known"] == sum(w in counts for w in tokens)
        assert r["base_score"] == pytest.approx(sum(log10((counts[w] + 1) / (n + v + 1)) for w in tokens))
    bits = [r["bits_per_byte"] for r in got.values() if r["held_out"] and r["n_tokens"] > 50]
    assert np.median(bits) < 3


def test_language(spark, documents):
    got = result(spark, "op7_language_id")
    assert all(got[d]["held_out"] == (remainder(d, 5) == 0) for d, *_ in documents)
    right = [got[d]["lang_pred"] == lang for d, _, lang, _ in documents if got[d]["held_out"]]
    assert np.mean(right) >= 0.95


def components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def linked(sets):
    names = sorted(sets)
    return [
        (a, b)
        for i, a in enumerate(names)
        for b in names[i + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]


def test_near_duplicates(spark, documents):
    sets = {d: shingles(t) for d, t, *_ in documents}
    root = components(linked(sets), sets)
    got = result(spark, "op8_lsh_forest")
    assert {d: r["component_id"] for d, r in got.items()} == root
    assert {d: r["n_shingles"] for d, r in got.items()} == {d: len(s) for d, s in sets.items()}
    assert all(r["kept"] == (d == root[d]) for d, r in got.items())


def test_near_duplicates_in_crowded_buckets(spark, monkeypatch):
    """Many edited copies of one text: parted buckets bind nothing wrongly and lose no link."""
    from clickloom.llm import near_dups

    monkeypatch.setattr(near_dups, "CROWD", 30)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(260):
        own = list(base)
        for i in rng.choice(120, rng.integers(0, 5), replace=False):
            own[i] = f"x{rng.integers(1000)}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    root = components(linked(sets), sets)
    got = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(docs).collect()}
    assert got == root


def test_chains_of_links(spark):
    from clickloom.llm.components import components as tabled

    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (3, 2), (2, 3)]
    got = {r["node"]: r["root"] for r in tabled(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 130)}


def test_token_ids(spark, documents):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got, start = result(spark, "op9_token_ids"), 0
    for d, t, *_ in documents:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert tuple(got[d])[1:] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_pieces_have_the_ids_of_the_whole_text():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from clickloom.llm.token_ids import TokenizerFile

    coder = TokenizerFile(public_tokenizers.path("byte_bpe_50k.json"))
    assert coder.in_pieces
    texts = [
        "", " ", "  ", "a b", " a b ", "a\n b", "a \nb", "a\t b", "a\xa0 b", "a \xa0b", "it's  we'll 12 345,\n\n x", "a   b",
        "\n \n", "x <|endoftext|> y<|endoftext|>", "中 文 \U0001f600 \U0001f600", "a\r\n b", "a   b", "1 \n\n 2",
    ]
    whole = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in coder.encode(texts)] == whole


def test_pieces_of_odd_texts_have_the_ids_of_the_whole_text():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from clickloom.llm.token_ids import TokenizerFile

    coder, pick = TokenizerFile(public_tokenizers.path("byte_bpe_50k.json")), random.Random(7)
    parts = [
        "a", "Bc", "é", "ß", "ª", "œ", "²", "1", "23", ",", ".", "!", "'", "'s", "'re", "_", "×", "Ж", "中", "\u0301", "\U0001f600",
        "\n", "\t", "\r", "\xa0", "\x85", "\x1c", "\u3000", " ", " ", " ", " ", "<|endoftext|>", "<|", "\x00",
    ]
    texts = [" \xa0 \xa0", *["".join(pick.choices(parts, k=pick.randint(0, 12))) for _ in range(20_000)]]
    whole = coder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    wrong = [t for t, w, own in zip(texts, whole, coder.encode(texts)) if own.tolist() != w.ids]
    assert wrong == []


def test_pieces_are_known_in_the_next_task(monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import pyarrow as pa

    from clickloom.llm import id_coder, token_ids

    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words, and\nsome more", None]})
    path = public_tokenizers.path("byte_bpe_50k.json")
    (first,) = token_ids._written(path, 0)(iter([batch]))
    monkeypatch.setattr(token_ids._Pieces, "_ids", None)
    (second,) = token_ids._written(path, 0)(iter([batch]))
    assert first == second
    (ids,) = id_coder.decode(second.column("blocks")[0].as_py())
    assert second.column("counts")[0].as_py() == [len(ids) - 1, 1] and ids[-2:].tolist() == [0, 0]


def test_forgotten_pieces_are_encoded_again(monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from clickloom.llm import token_ids

    monkeypatch.setattr(token_ids, "MEMO_PIECES", 3)
    coder = token_ids.TokenizerFile(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["one two three", "four, five", "two six", "seven", "one two"] * 2
    assert [x.tolist() for x in coder.encode(texts)] == [
        coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts
    ]


def test_sharding(spark, documents):
    got = result(spark, "op10_sharding")
    sizes = [len((t or "").encode()) + 8 for _, t, *_ in documents]
    total, before, slots = sum(sizes), 0, Counter()
    for (d, t, *_), size in zip(documents, sizes):
        shard = (2 * before + size) * 24 // (2 * total)
        crc = zlib.crc32((t or "").encode())
        assert tuple(got[d]) == (d, size, crc, "bytes", shard, slots[shard], None)
        slots[shard] += 1
        before += size


def test_pipeline(spark, documents, items):
    """Stage by stage in plain Python; packing is checked by what it holds."""
    kept = {d: t for d, t, *_ in documents if t and re.search(r"[^\W\d_]", t)}
    holder: dict[str, set[int]] = defaultdict(set)

    def key(line):
        return line.strip(" \t\n\v\f\r").encode().lower().decode()

    for d, t in kept.items():
        for line in t.split("\n"):
            holder[key(line)].add(d)
    cut = {}
    for d, t in kept.items():
        lines = t.split("\n")
        rest = [x for x in lines if len(key(x)) < 10 or min(holder[key(x)]) == d]
        if len(rest) == len(lines) or words("\n".join(rest)):
            cut[d] = "\n".join(rest)
    sets = {d: shingles(t) for d, t in cut.items()}
    root = components(linked(sets), sets)
    single = [(d, t) for d, t in cut.items() if root[d] == d]
    leaks = {d for d, _ in held(single, items)}
    expected = {d: len(words(t)) + 1 for d, t in single if d not in leaks}
    got = Counter()
    for r in corpus_pipeline.run(spark, SMALL).collect():
        got[r["doc_id"]] += r["n_words"]
    assert got == expected


def test_binomial_tail(spark):
    from math import comb

    from pyspark.sql import functions as F

    from clickloom.llm.quality import binomial_tail

    cases = [(n, k) for n in (1, 7, 200, 3000) for k in (0, 1, n // 50, n // 10)]
    rows = spark.createDataFrame(cases, "n long, k long").withColumn("p", binomial_tail(F.col("n"), F.col("k"), 0.01))
    for r in rows.collect():
        exact = sum(comb(r["n"], i) * 0.01**i * 0.99 ** (r["n"] - i) for i in range(r["k"] + 1) if comb(r["n"], i) < 1e300)
        if r["k"] <= r["n"] * 0.02:
            assert r["p"] == pytest.approx(exact, rel=1e-9)
