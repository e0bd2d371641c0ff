"""Disclosure sanitisation, ranked search and the conversation trie against plain computations."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from math import floor, fmod, log

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import fp_tree, personal_data, prefix_trie, ranked_search
from clickloom.llm.queries import QUERIES
from clickloom.llm.radix_tree import LAYOUTS, RadixTree
from conftest import SMALL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- op 11

# The base contract as it is written.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub(r"\D", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub(r"\D", "", m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], personal_data.KINDS.index(s[0])))


def test_base_spans_on_odd_texts():
    rng = random.Random(5)
    pieces = ["a@b", "@", "@@", ".", "..", "-", "+", "+1", " ", "  ", "(", ")", "4111 1111 1111 1111", "4111-1111", "\n"]
    pieces += ["1.2.3.4", "256", "0001.02.3.4", "x.y", "a.b@c-d.e", "%", "+49 30 1234567", "é", "12", "999999999999", "0", "@c.d@e.f"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 12)))
        assert personal_data.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "@a" * 100_000, "1." * 100_000, "+1" * 100_000, "+1(" + "(" * 200_000])
def test_base_spans_take_linear_time(text):
    assert personal_data.base_spans(text) is not None


def test_op11_base_columns(spark):
    texts = dict(duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall())
    got = {r["doc_id"]: r for r in QUERIES["op11_disclosure_sanitisation"](spark, SMALL).collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        spans = plain_spans(text or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        kinds = Counter(k for k, *_ in spans)
        r = got[doc_id]
        assert [r[f"n_{k}"] for k in personal_data.KINDS] == [kinds[k] for k in personal_data.KINDS]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


def plain_disclosure(docs, window, least, generalise, remove):
    """Spans of every document by a direct computation."""
    n_entity, n_word, n_both, texts = Counter(), Counter(), Counter(), defaultdict(set)
    near = []
    for _, text in docs:
        text = text or ""
        spans = plain_spans(text)
        inside = [any(s <= i < e for _, s, e in spans) for i in range(len(text))]
        outside = "".join(" " if hidden else c for c, hidden in zip(text, inside))
        terms = [(lowered(m[0]), *m.span()) for m in TERM.finditer(outside)]
        found = set()
        for kind, s, e in spans:
            entity = personal_data.entity_of(kind, text[s:e])
            found |= {(entity, *t) for t in [t for t in terms if t[2] <= s][-window:] + [t for t in terms if t[1] >= e][:window]}
        near.append(found)
        n_word.update({lowered(m[0]) for m in TERM.finditer(text)})
        n_entity.update({f[0] for f in found})
        for pair in {f[:2] for f in found}:
            n_both[pair] += 1
            texts[pair].add(text)
    out = []
    for (doc_id, text), found in zip(docs, near):
        worst = {}
        for entity, term, s, e in found:
            if len(texts[entity, term]) < least or n_entity[entity] == len(docs):
                continue
            share = log(n_both[entity, term] * len(docs) / (n_entity[entity] * n_word[term])) / log(len(docs) / n_entity[entity])
            if share >= generalise:
                worst[s, e] = max(worst.get((s, e), 0), share)
        spans = plain_spans(text or "") + [("removed" if d >= remove else "generalised", *at) for at, d in worst.items()]
        out.append((doc_id, sorted(spans, key=lambda s: (s[1], personal_data.ALL_KINDS.index(s[0])))))
    return out


@pytest.fixture(scope="module")
def letters():
    rng = np.random.default_rng(11)
    common = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(120):
        words = list(rng.choice(common, 12))
        if i % 6 == 0:  # one person, always with the same odd words, and others in passing
            words[5:5] = ["Captain", "zorro7", "Ann@mail.example.com", "of", "isle", "99"]
        elif i % 10 == 1:
            words[3:3] = ["isle", f"x{i}@mail.example.com"]
        docs.append((i, " ".join(words)))
    return [*docs, (200, docs[0][1]), (201, None), (202, ""), (None, docs[6][1]), (203, "Captain zorro7 alone")]


def test_disclosing_terms(spark, letters):
    df = spark.createDataFrame(letters, "doc_id long, text string").withColumns({"kind": F.lit("x"), "near": F.lit(1)})
    got = [(r["doc_id"], [tuple(s) for s in r["spans"]]) for r in personal_data.find(df).collect()]
    expected = plain_disclosure(letters, personal_data.WINDOW, personal_data.LEAST_TEXTS, personal_data.GENERALISE, personal_data.REMOVE)
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    kinds = Counter(s[0] for _, spans in got for s in spans)
    assert kinds["removed"] and kinds["generalised"] and kinds["email"]
    assert dict(got)[203] == []  # no entity there, nothing to protect


def test_redaction(spark, letters):
    df = spark.createDataFrame(letters, "doc_id long, text string").withColumn("sanitised", F.lit("mine"))
    out = personal_data.redact(df, personal_data.find(df)).collect()
    assert sorted((r["doc_id"] for r in out), key=repr) == sorted((d for d, _ in letters), key=repr)
    for r in out:
        assert (r["sanitised"] is None) == (r["text"] is None)
        assert "@" not in (r["sanitised"] or "")
        if r["text"] and "@" not in r["text"]:
            assert r["sanitised"] == r["text"]
    assert personal_data.find(df.limit(0)).count() == 0


# --- op 12


def plain_search(docs, items, keep):
    held = [(d, Counter(TERM.findall(lowered(t)))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(TERM.findall(lowered(t)))
    out = []
    for item, terms in wanted.items():
        scored = []
        for d, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = sum(floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        scored.sort()
        out += [(item, k, d, -s) for k, (s, _, _, d) in enumerate(scored[:keep], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("leaf, tree", [(192, 8192), (3, 50), (0, 7)])
def test_search(spark, monkeypatch, leaf, tree):
    monkeypatch.setattr(fp_tree, "LEAF", leaf)
    monkeypatch.setattr(ranked_search, "TREE_DOCS", tree)
    rng = np.random.default_rng(leaf)
    words = [f"t{i}" for i in range(40)] + ["É", "ß1", "a\xa0b"]
    weights = 1 / np.arange(1, len(words) + 1)
    docs = [(int(i), " ".join(rng.choice(words, rng.integers(1, 30), p=weights / weights.sum()))) for i in range(150)]
    docs += [(7, docs[7][1]), (None, docs[7][1]), (None, docs[7][1]), (500, None), (501, ""), (502, "... !"), (503, "T1-t1_T1 " * 900)]
    docs += [(1000 + i, "t1 t2 t3") for i in range(70)]  # ties
    items = [(i, " ".join(rng.choice(words, 6))) for i in range(15)] + [(99, None), (98, ""), (None, "t1 t30"), (97, "nowhere"), (3, "T39 t2")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"rank": F.lit(1), "item_id": F.lit(2), "tf": F.lit(1)})
    got = ranked_search.search(d, spark.createDataFrame(items, "item_id long, text string"), 50)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_search(docs, items, 50)


def test_search_in_blocks_and_without_rows(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", 8)
    docs = [(1, "a b c"), (2, "b c d"), (3, "c d e f")]
    items = [(1, "a b"), (2, "c d"), (3, "f"), (4, None)]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = ranked_search.search(d, i, 2)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_search(docs, items, 2)
    assert ranked_search.search(d.limit(0), i).count() == 0
    assert ranked_search.search(d, i.limit(0)).count() == 0


# --- op 13


@pytest.mark.parametrize("width", [1, 2, 16])
def test_radix_tree(width):
    rng = random.Random(width)
    parts = [bytes(rng.randrange(256) for _ in range(width)) for _ in range(300)]
    keys = {b""} | {b"".join(rng.choices(parts[: rng.choice([2, 20, 300])], k=rng.randint(0, 5))) for _ in range(3000)}
    keys = list(keys)
    rng.shuffle(keys)
    tree = RadixTree()
    for key in keys:
        tree.add(key)
    found = [tree.keys[node.ends] for node, _ in tree.preorder() if node.ends is not None]
    assert found == sorted(keys)
    for node, above in tree.preorder():
        assert above is None or node.depth > above.depth
        assert node.ends is not None or len(node.children()) > 1
    layouts = {type(node.layout) for node, _ in tree.preorder() if node.layout}
    assert layouts == set(LAYOUTS)
    with pytest.raises(ValueError):
        tree.add(keys[0])


def plain_trie(conversations):
    own = defaultdict(list)
    for c, turn, role, text in conversations:
        if c is not None:
            key = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, key, role or "", text or ""))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = turns.get(c - int(fmod(c, 20)), [])[:h] + ts[h:]  # the remainder has the sign of c
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in rebuilt.items():
        ends[tuple(ts)].append(c)
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own_members in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(own_members) - 1) * words
    return sorted(
        (
            (
                min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
            )
            for p, m in members.items()
        ),
        key=repr,
    )


@pytest.mark.parametrize("run_keys, list_bytes", [(100_000, 65536), (1, 1), (3, 10)])
def test_trie(spark, monkeypatch, run_keys, list_bytes):
    monkeypatch.setattr(prefix_trie, "RUN_KEYS", run_keys)
    monkeypatch.setattr(prefix_trie, "LIST_BYTES", list_bytes)
    rng = random.Random(run_keys)
    data = []
    for c in range(160):
        if c % 9 == 4:
            continue
        for turn in range(rng.choice([1, 2, 3, 5, 9])):
            data.append((c, turn if rng.random() > 0.1 else None, rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", "", None, " d\te "])))
    data += [(300, t, "user", "the same") for t in range(40)] + [(c, t, "user", "the same") for c in range(301, 340) for t in range(4)]
    data += [(5, 1, "user", "twice"), (5, 1, "user", "twice"), (-7, 0, "x", "below zero"), (None, 0, "user", "nobody"), (400, 5000, "user", "late"), (400, 3, "a", "early")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumns({"key": F.lit(1), "depth": F.lit(1)})
    got = sorted((tuple(r) for r in prefix_trie.prefix_trie(df.repartition(7)).collect()), key=repr)
    assert got == plain_trie(data)


def test_trie_without_rows(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(df).count() == 0
