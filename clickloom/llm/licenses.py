"""License scan: phrases, and an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.common import in_small_batches
from clickloom.llm.shingles import PLAIN

# Phrases and their labels, and what people put into their files from the licenses named.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mit-release": "released under the mit license",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    "bsd-3-clause-text": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior
        written permission.""",
    "gpl-3.0-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details. You should have received a copy of the GNU General Public License along
        with this program. If not, see https://www.gnu.org/licenses/.""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
        SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
        IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE.""",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice shall be included in all copies or substantial portions of the Software. THE
        SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS
        OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
}
CONTAINMENT = 0.85
LEAST_STEP = 32
MAX_TEMPLATES = 10_000


def words_of(text: str) -> list[bytes]:
    """Runs of a-z (A-Z lowered), digits and characters beyond ASCII."""
    return text.encode("utf-8", "replace").translate(PLAIN).split()


@dataclass(frozen=True)
class Template:
    """Tokens in global order, rarest first; a match holds at least ``least`` of them, so one of the prefix."""

    label: str
    tokens: tuple[bytes, ...]
    least: int

    @property
    def prefix(self) -> tuple[bytes, ...]:
        return self.tokens[: len(self.tokens) - self.least + 1]


class TemplateIndex:
    def __init__(self, templates: Sequence[tuple[str, frozenset[bytes]]], frequency: Mapping[bytes, int], containment: float):
        universe = set().union(*[t for _, t in templates])
        self.rank = {t: i for i, t in enumerate(sorted(universe, key=lambda t: (frequency.get(t, 0), t)))}
        self.by_token: dict[bytes, list[tuple[Template, int]]] = {}
        for label, tokens in templates:
            ordered = tuple(sorted(tokens, key=self.rank.__getitem__))
            template = Template(label, ordered, max(1, math.ceil(round(containment * len(ordered), 9))))
            for i, token in enumerate(template.prefix):
                self.by_token.setdefault(token, []).append((template, i))
        self.prefixes = frozenset(self.by_token)

    def matches(self, block: set[bytes]) -> Iterator[tuple[str, float]]:
        """Label and containment of every template that the block holds enough of.

        Tokens of no template come last in the global order and cannot add to an overlap. Length filter: the
        block needs as many template tokens as a match. Positional filter: after the first common token at
        place i of the template and j of the block no more than the shorter rest can be common.
        """
        ordered = sorted(block & self.rank.keys(), key=self.rank.__getitem__)
        seen = set()
        for j, token in enumerate(ordered):
            for template, i in self.by_token.get(token, ()):
                if template.label in seen:
                    continue
                seen.add(template.label)
                size = len(template.tokens)
                if len(ordered) < template.least or min(size - i, len(ordered) - j) < template.least:
                    continue
                common = len(block.intersection(template.tokens))
                if common >= template.least:
                    yield template.label, common / size


def block_step(n_words: int) -> int:
    """Blocks for a template start this many words apart and are twice as long: a power of two that holds it."""
    return max(LEAST_STEP, 1 << (n_words - 1).bit_length()) if n_words else LEAST_STEP


def indexes_by_step(
    templates: Mapping[str, Sequence[bytes]], frequency: Mapping[bytes, int], containment: float
) -> list[tuple[int, TemplateIndex]]:
    by_step: dict[int, list[tuple[str, frozenset[bytes]]]] = {}
    for label, words in templates.items():
        by_step.setdefault(block_step(len(words)), []).append((label, frozenset(words)))
    return [(step, TemplateIndex(own, frequency, containment)) for step, own in sorted(by_step.items())]


def phrase_places(words: list[bytes], phrases: Mapping[bytes, str]) -> list[tuple[int, str]]:
    line = b" " + b" ".join(words) + b" "
    places = []
    for phrase, label in phrases.items():
        at, counted, before = line.find(b" " + phrase + b" "), 0, 0
        while at >= 0:
            before, counted = before + line.count(b" ", counted, at), at
            places.append((before, label))
            at = line.find(b" " + phrase + b" ", at + 1)
    return places


def _token_counts(universe: frozenset[bytes]):
    """In how many documents of a task each template token stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                n.update(universe.intersection(words_of(text or "")))
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], ["token", "n"])

    return run


_FOUND = pa.list_(
    pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("containment", pa.float64())])
)
_SCHEMA = [
    ("n_words", pa.int64()),
    ("n_base", pa.int64()),
    ("first_word", pa.int64()),
    ("last_word", pa.int64()),
    ("base_labels", pa.string()),
    ("labels", pa.string()),
    ("score", pa.float64()),
    ("blocks", _FOUND),
]


def scan_text(text: str, phrases: Mapping[bytes, str], indexes: Sequence[tuple[int, TemplateIndex]]) -> tuple:
    words = words_of(text)
    places = phrase_places(words, phrases)
    blocks = []
    for step, index in indexes:
        if index.prefixes.isdisjoint(words):
            continue
        at = {i // step for i, w in enumerate(words) if w in index.prefixes}
        for b in sorted(at | {b - 1 for b in at if b}):
            block = words[b * step : (b + 2) * step]
            blocks += [(label, b * step, len(block), share) for label, share in sorted(index.matches(set(block)))]
    base = {label for _, label in places}
    starts = [i for i, _ in places]
    return (
        len(words),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | {label for label, *_ in blocks})),
        1.0 if places else max((share for *_, share in blocks), default=0.0),
        [dict(zip(("label", "first_word", "n_words", "containment"), b)) for b in blocks],
    )


def scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """doc_id, word count, phrase places and labels, and every block that holds enough of a template.

    The blocks of a template start at every ``step``-th word, over line ends, and are twice as long, where ``step``
    is the power of two, 32 at least, that holds all its words: a passage as long as the template lies whole in one.
    Containment in a block is the share of the template's distinct words found there.
    A first pass counts in how many documents each template word stands; that order, rarest first, makes the
    prefixes that the second pass looks up. The templates are a parameter of at most 10,000 entries.

    ``labels`` has phrase and template labels. ``score`` is 1 if a phrase was found, else the highest
    containment of a block that reached the threshold, else 0. NULL and empty texts have no words; rows may
    repeat; an empty table gives no rows; other columns are not read.
    """
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"at most {MAX_TEMPLATES} templates")
    words = {label: words_of(text) for label, text in templates.items()}
    wanted = {phrase.encode(): label for phrase, label in phrases.items()}
    texts = in_small_batches(docs).select("doc_id", "text")
    universe = frozenset().union(*words.values())
    tally = texts.mapInArrow(_token_counts(universe), "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))
    frequency = {bytes(r["token"]): r["n"] for r in tally.collect()}  # one row per template word
    indexes = indexes_by_step(words, frequency, containment)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan_text(t or "", wanted, indexes) for t in batch.column("text").to_pylist()]
            columns = list(zip(*rows)) or [[]] * len(_SCHEMA)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, kind) for c, (_, kind) in zip(columns, _SCHEMA)]],
                ["doc_id", *[name for name, _ in _SCHEMA]],
            )

    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        run,
        f"doc_id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, "
        "blocks array<struct<label: string, first_word: bigint, n_words: bigint, containment: double>>",
    )
