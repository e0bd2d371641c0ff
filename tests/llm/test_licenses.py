"""License scan against windows compared one by one, with templates of many lengths."""

import random

import pytest

from clickloom.llm import licenses

TEXTS = {label: [w.decode() for w in licenses.words_of(text)] for label, text in licenses.TEMPLATES.items()}


def every_block(text, templates, containment):
    words, found = licenses.words_of(text or ""), []
    for label, template in templates.items():
        tokens = licenses.words_of(template)
        step = 32
        while step < len(tokens):
            step *= 2
        for start in range(0, len(words), step):
            share = len(set(words[start : start + 2 * step]) & set(tokens)) / len(set(tokens))
            if share >= containment:
                found.append((label, start, share))
    return sorted(found)


def documents():
    dice = random.Random(5)
    filler = [f"w{i}" for i in range(300)] + ["the", "of", "software", "license", "copyright", "and"]
    rows = [(0, None), (1, ""), (2, licenses.TEMPLATES["mit-text"])]
    for label, words in TEXTS.items():
        for edits in (0.0, 0.05, 0.2, 0.5):
            before = dice.choices(filler, k=dice.randrange(400))
            copy = [dice.choice(filler) if dice.random() < edits else w for w in words]
            rows.append((len(rows), " ".join([*before, *copy, *dice.choices(filler, k=60)])))
    return rows


@pytest.fixture(scope="module")
def found(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return rows, {r["doc_id"]: r for r in licenses.scan(docs).collect()}


def test_blocks_are_those_of_a_plain_comparison(found):
    rows, got = found
    for doc_id, text in rows:
        blocks = sorted((b["label"], b["first_word"], b["containment"]) for b in got[doc_id]["blocks"])
        assert blocks == every_block(text, licenses.TEMPLATES, licenses.CONTAINMENT)


def test_whole_license_texts_are_found_wherever_they_stand(found):
    _, got = found
    assert "mit-text" in got[2]["labels"].split(",")
    for i, label in enumerate(TEXTS):
        assert label in got[3 + 4 * i]["labels"].split(",")
        assert label in got[4 + 4 * i]["labels"].split(",") or len(TEXTS[label]) < 20


def test_places_of_many_phrases():
    words = licenses.words_of("cc by, " * 500 + "MIT License")
    places = licenses.phrase_places(words, {b"cc by": "cc-by", b"mit license": "mit"})
    assert places == [*((2 * i, "cc-by") for i in range(500)), (1000, "mit")]
