"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F, types as T

import corpus_pipeline
from clickloom.llm import (
    decontaminate, language, licenses, line_dedup, lm_score, near_dups, packing, quality, sharding, token_ids,
)

public_tokenizers = pytest.importorskip("public_tokenizers")

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(n, T.StringType()) for n in ("key", "rep", "score", "kept", "size", "n_lines", "group", "words")],
    ]
)
LONG = " ".join(f"word{i % 997} of line{i}" for i in range(60_000))
PROSE = "The cat sat on the mat and looked at the other cat for a very long time indeed."
TEXTS = [
    (1, PROSE, "en", "a"),
    (2, PROSE, "en", "a"),
    (2, PROSE, "en", "a"),
    (3, "", "en", None),
    (4, None, None, None),
    (None, PROSE, "en", "b"),
    (5, LONG, "xx", "a"),
    (6, "\n\n  \n", "de", "b"),
    (7, "Der Hund und die Katze\nsind nicht\tim Haus \U0001f600 \x00 \xa0 end", "de", "b"),
    (8, "12345 !!", None, "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, s, len(t) if t else None, *["x"] * 8) for i, t, lang, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, PROSE), (1, PROSE), (2, None), (3, ""), (None, "too short here"), (4, "nothing like this is anywhere in here")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (None, 1), (99, 1), (5, None)], "doc_id long, quality int")


def flagged(docs):
    return docs.withColumn("held_out", F.when(F.col("doc_id") == 7, True))


def operators(benchmark, labels):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return {
        "decontaminate": lambda d: decontaminate.contaminated(d, benchmark),
        "packing": packing.pack,
        "line_dedup": lambda d: line_dedup.dedup_lines(d).select("doc_id", "n_lines", "n_dropped", "kept_text"),
        "lm_score": lambda d: lm_score.score(flagged(d)),
        "quality": lambda d: quality.judge(d, labels).select("doc_id", "n_words", "base_failed", "kept"),
        "licenses": licenses.scan,
        "language": lambda d: language.predict(d, language.fit(d)).select("doc_id", "lang_pred", "score"),
        "near_dups": near_dups.near_duplicates,
        "token_ids": lambda d: token_ids.with_starts(token_ids.read_ids(token_ids.write_ids(d, path))),
        "sharding": sharding.shard_by_bytes,
    }


NAMES = (
    "decontaminate", "packing", "line_dedup", "lm_score", "quality", "licenses", "language", "near_dups",
    "token_ids", "sharding",
)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(nothing, benchmark, labels, name):
    assert operators(benchmark, labels)[name](nothing).count() == 0


@pytest.mark.parametrize("name", [n for n in NAMES if n not in ("decontaminate", "packing")])
def test_one_row_for_each_row(docs, benchmark, labels, name):
    got = [r["doc_id"] for r in operators(benchmark, labels)[name](docs).collect()]
    assert sorted(got, key=repr) == sorted((t[0] for t in TEXTS), key=repr)


def test_decontaminate(docs, benchmark):
    got = sorted(map(tuple, decontaminate.contaminated(docs, benchmark).collect()), key=repr)
    assert got == [(1, 1, 1.0, 0, 17), (2, 1, 1.0, 0, 17), (None, 1, 1.0, 0, 17)]


def test_packing_keeps_clusters_apart(spark):
    """Near copies named by a column: no bin holds two of them, while rows without a cluster share bins."""
    rows = [(i, f"text number {i} of some", f"s{i}", i % 4 if i < 40 else None) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, component_id long")
    got = packing.pack(docs, capacity=30, cluster="component_id").collect()
    assert sorted(r["doc_id"] for r in got) == list(range(60))
    bins: dict[int, list] = {}
    for r in got:
        bins.setdefault(r["bin"], []).append(rows[r["doc_id"]][3])
    for held in bins.values():
        named = [c for c in held if c is not None]
        assert len(named) == len(set(named))
    assert len({r["bin"] for r in packing.pack(docs, capacity=30).collect()}) == 12
    assert max(map(len, bins.values())) == 5


def test_packing_places_every_word_once(docs):
    got = packing.pack(docs, capacity=1000).collect()
    taken = {}
    for r in got:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["n_words"]
    words = {}
    for i, t, *_ in TEXTS:
        words[i] = words.get(i, 0) + len((t or "").encode().split()) + 1
    assert taken == words
    assert max(r["bin_offset"] + r["n_words"] for r in got) <= 1000


def test_line_dedup(docs):
    got = {}
    for r in line_dedup.dedup_lines(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["n_lines"], r["n_dropped"], r["kept_text"]))
    assert got[1] == [(1, 0, PROSE)]
    assert got[2] == [(1, 1, ""), (1, 1, "")]
    assert got[None] == [(1, 0, PROSE)]
    assert got[3] == got[4] == [(1, 0, "")]
    assert got[6] == [(4, 0, "\n\n  \n")]


def test_line_dedup_keeps_other_columns(docs):
    got = line_dedup.dedup_lines(docs)
    assert set(docs.columns) | {"n_dropped", "kept_text"} == set(got.columns)
    assert {r["key"] for r in got.collect()} == {"x"}


def test_near_dups(docs):
    got = {r["doc_id"]: tuple(r)[1:] for r in near_dups.near_duplicates(docs).collect()}
    assert got[1] == (14, 1, True) and got[2] == (14, 1, False)
    assert got[3] == (0, 3, True) and got[4] == (0, 4, True)
    assert got[None] == (14, None, True)
    assert got[8] == (1, 8, True)


def test_language(docs):
    model = language.fit(docs)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, model).collect()}
    assert got[1][0] == "en" and got[7][0] == "de"
    assert got[3] == got[4] == got[6] == got[8] == ("und", 0.0)


@pytest.mark.parametrize("text, known", [("½", False), ("²", False), ("Ⅷ 12", False), ("ª", True), ("é", True), ("中", True), ("_", False)])
def test_letters(spark, docs, text, known):
    got = language.predict(spark.createDataFrame([(text,)], "text string"), language.fit(docs)).first()
    assert (got["lang_pred"] != "und") == known


def test_too_many_languages_are_refused(spark):
    labelled = spark.createDataFrame([("a", f"l{i}") for i in range(9)], "text string, lang string")
    with pytest.raises(ValueError, match="fewer bits"):
        language.fit(labelled, bits=22)


def test_language_without_labels(docs):
    model = language.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language.predict(docs, model).collect()} == {"und"}


def test_lm_score(docs):
    got = {r["doc_id"]: r for r in lm_score.score(flagged(docs)).collect()}
    assert got[3]["n_tokens"] == got[4]["n_tokens"] == 1
    assert got[7]["held_out"] and not got[1]["held_out"]
    assert got[7]["n_known"] < got[7]["n_tokens"]
    assert all(r["score"] < 0 and r["base_score"] < 0 for r in got.values())
    assert got[3]["score"] == got[4]["score"]


def test_quality(docs, labels):
    got = {r["doc_id"]: r for r in quality.judge(docs, labels).collect()}
    assert got[3]["n_words"] == got[4]["n_words"] == got[6]["n_words"] == 0
    assert got[1]["base_failed"] and not got[1]["kept"]
    assert got[5]["kept"]


def test_sharding_cuts_in_order(docs):
    got = sharding.shard_by_bytes(docs, 3).collect()
    ordered = sorted(got, key=lambda r: (-1 if r["doc_id"] is None else r["doc_id"], r["shard"], r["slot"]))
    assert [r["shard"] for r in ordered] == sorted(r["shard"] for r in got)
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("table", ["docs", "nothing"])
def test_pipeline_stages(spark, tmp_path, benchmark, request, table):
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = request.getfixturevalue(table)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        got = stage(spark, docs, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert got.columns == docs.columns
            # Columns that a stage does not own keep their values, whatever they are called.
            own = ["lang", "source", "key", "rep", "score", "kept", "size", "n_lines", "group", "words"]
            before = {tuple(r) for r in docs.select("doc_id", *own).collect()}
            assert {tuple(r) for r in got.select("doc_id", *own).collect()} <= before
        got.write.parquet(path)
        docs = spark.read.parquet(path)
    if table == "docs":
        # 1 and 2 hold a benchmark item, 2 lost all its lines before, the others have no letters.
        assert {r["doc_id"] for r in docs.collect()} == {5, 7}
