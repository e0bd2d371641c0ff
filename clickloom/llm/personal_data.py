"""Personal data in texts, and the words that give it away (op 11).

Base: e-mail addresses, IP addresses, card and phone numbers found by pattern. Each distinct value is a
protected entity. Words beside its mentions are candidates; how much one discloses is measured over the
corpus: the pointwise mutual information of word and entity, as a share of all the information the entity has,

    log(n_both * n_documents / (n_entity * n_word)) / log(n_documents / n_entity)

counted in documents. It is 1 for a word that never occurs without the entity. A candidate needs the evidence of
``LEAST_TEXTS`` different texts. From ``GENERALISE`` on it is replaced by its kind, from ``REMOVE`` on it is
taken out, where it stands beside the entity; documents without an entity are left as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from clickloom.llm.bloom import filter_of, found as in_filter, positions, segments_for, unpacked
from clickloom.llm.common import clear_of, in_small_batches, lower_ascii, texts_in
from clickloom.llm.shingles import PLAIN
from clickloom.session import materialize

# Fixed values of the base contract.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit before cannot start a match: what fails or ends there has taken the whole run of digits.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Kinds that co-occurrence adds, in the order of spans that start alike.
GENERALISED, REMOVED = "generalised", "removed"
ALL_KINDS = (*KINDS, GENERALISED, REMOVED)
WINDOW = 8  # words on each side of a mention
LEAST_TEXTS = 3
GENERALISE, REMOVE = 0.7, 0.9
#: Terms counted in a task before the counts are handed on.
COUNTED_TERMS = 200_000

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
MENTIONED = (
    "doc_id long, text_key string, base array<struct<kind: string, start: long, end: long>>, "
    "near array<struct<entity: string, term: string, start: long, end: long>>"
)


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(d * 2 - 9 * (d > 4) for d in values[1::2])) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """As the leftmost matches of local part, @ and dotted domain, in time linear in the text.

    No part of a match holds a second @, so each @ is tried once, with all local characters before it that no
    earlier match took.
    """
    free, at = 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all base matches by start, then kind."""
    spans = [("email", *s) for s in emails(text)]
    if re.search("[0-9]", text):
        for m in IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
                spans.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            if len(m[0]) <= 37 and 12 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d):
                spans.append(("card", *m.span()))
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append(("phone", *m.span()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def entity_of(kind: str, text: str) -> str:
    """One spelling for all ways to write a value."""
    return f"{kind}:" + (lower_ascii(text) if kind in ("email", "ip") else re.sub("[^0-9]", "", text))


def beside(text: str, spans: list[tuple[str, int, int]], window: int) -> set[tuple[str, str, int, int]]:
    """(entity, term, start, end) of the terms among ``window`` terms on each side of a mention, but none inside one."""
    covered: list[list[int]] = []
    for _, start, end in spans:
        if covered and start < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    # The terms of every gap between mentions that can be in reach of one: the first and last few of the gap.
    gaps = [(a[1], b[0]) for a, b in pairwise([[0, 0], *covered, [len(text), len(text)]])]
    after, before = [], []
    for start, end in gaps:
        ahead = islice(TERM.finditer(text, start, end), window)
        back, reach = [], 32 * window
        while True:
            cut = max(start, end - reach)
            while cut > start and TERM.match(text[cut - 1]):
                cut -= 1
            back = list(TERM.finditer(text, cut, end))
            if len(back) >= window or cut == start:
                break
            reach *= 4
        after.append([(lower_ascii(m[0]), *m.span()) for m in ahead])
        before.append([(lower_ascii(m[0]), *m.span()) for m in back[-window:]])
    found, block = set(), 0
    for kind, start, end in spans:
        while covered[block][1] <= start:
            block += 1
        entity = entity_of(kind, text[start:end])
        # Gaps beside the mention's own block; a short gap reaches on into the next one.
        for gap_step, gap, listed in ((-1, block, before), (1, block + 1, after)):
            left = window
            while left > 0 and 0 <= gap < len(gaps):
                terms = listed[gap][-left:] if gap_step < 0 else listed[gap][:left]
                found.update((entity, *t) for t in terms)
                left -= len(listed[gap])
                gap += gap_step
    return found


def mentions(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Base spans of every document, and the terms beside them (none for most)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, bases, nears = [], [], []
            for text in texts_in(batch):
                spans = base_spans(text)
                keys.append(text_key(text) if spans else None)
                bases.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
                near = sorted(beside(text, spans, window)) if spans else []
                nears.append([{"entity": n, "term": t, "start": s, "end": e} for n, t, s, e in near])
            span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
            other = pa.struct([("entity", pa.string()), ("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.string()), pa.array(bases, pa.list_(span)), pa.array(nears, pa.list_(other))],
                names=["doc_id", "text_key", "base", "near"],
            )

    return in_small_batches(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(run, MENTIONED)


def document_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n_word): in how many of all documents each of the terms occurs.

    A Bloom filter of at most 16 MiB picks candidates in the texts; its errors go in the join with ``terms``.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict(
                {"h": pa.array(np.array([xxhash.xxh64_intdigest(t) for t in batch.column(0).to_pylist()], np.uint64).view(np.int64))}
            )

    segments = segments_for(terms.count())
    packed = filter_of(terms.mapInArrow(hashed, "h long"), segments)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known, counts = unpacked(packed), {}, Counter()

        def written():
            out = pa.RecordBatch.from_pydict(
                {"term": pa.array([t.decode("utf-8", "replace") for t in counts], pa.string()), "n": pa.array(counts.values(), pa.int64())}
            )
            counts.clear()
            return out

        for batch in batches:
            for text in texts_in(batch):
                words = set(text.encode("utf-8", "replace").translate(PLAIN).split())
                new = [w for w in words if w not in known]
                if new:
                    if len(known) > COUNTED_TERMS:
                        known.clear()
                        new = list(words)
                    h = np.array([xxhash.xxh64_intdigest(w) for w in new], np.uint64)
                    known.update(zip(new, in_filter(bits, positions(h, segments)).tolist()))
                counts.update(w for w in words if known[w])
                if len(counts) > COUNTED_TERMS:
                    yield written()
        if counts:
            yield written()

    partial = in_small_batches(docs.select("text")).mapInArrow(run, "term string, n long")
    return partial.groupBy("term").agg(F.sum("n").alias("n_word")).join(terms, "term")


def disclosing(docs: DataFrame, mentioned: DataFrame, least_texts: int, generalise: float) -> DataFrame:
    """(entity, term, disclosure) of the pairs whose disclosure is at least ``generalise``."""
    # One row per document and pair: a document names each pair once however often it repeats it.
    seen = mentioned.where(F.size("near") > 0).select(
        "text_key", F.explode(F.array_distinct(F.transform("near", lambda n: F.struct(n["entity"], n["term"])))).alias("p")
    )
    by_text = seen.groupBy(F.col("p.entity").alias("entity"), F.col("p.term").alias("term"), "text_key").count()
    pairs = materialize(
        by_text.groupBy("entity", "term")
        .agg(F.sum("count").alias("n_both"), F.count(F.lit(1)).alias("n_texts"))
        .where(F.col("n_texts") >= least_texts),
        "pairs",
    )
    entities = mentioned.where(F.size("near") > 0).select(
        F.explode(F.array_distinct(F.transform("near", lambda n: n["entity"]))).alias("entity")
    )
    n_entity = entities.join(pairs.select("entity").distinct(), "entity", "left_semi").groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    n_word = document_counts(docs, materialize(pairs.select("term").distinct(), "terms"))
    total = F.lit(docs.count()).cast("double")
    whole = F.log(total / F.col("n_entity"))
    # An entity in every document has no information to disclose.
    share = F.log(F.col("n_both") * total / (F.col("n_entity") * F.col("n_word"))) / F.nullif(whole, F.lit(0.0))
    joined = pairs.join(n_entity, "entity").join(n_word, "term")
    return joined.select("entity", "term", share.alias("disclosure")).where(F.col("disclosure") >= generalise)


def find(
    docs: DataFrame, window: int = WINDOW, least_texts: int = LEAST_TEXTS, generalise: float = GENERALISE, remove: float = REMOVE
) -> DataFrame:
    """One row per document: doc_id, text_key (NULL if there is nothing), base and all spans.

    Spans are structs (kind, start, end) by start, then kind in the order of ALL_KINDS, in code points, the end
    exclusive. A NULL text is an empty one; repeated rows are documents each, but one text as evidence; an
    empty table has no rows; other columns are ignored.
    """
    numbered = mentions(docs, window).withColumn("row", F.monotonically_increasing_id())
    mentioned = materialize(numbered, "mentions")
    known = materialize(disclosing(docs, mentioned, least_texts, generalise), "disclosing")
    near = mentioned.where(F.size("near") > 0).select("row", F.explode("near").alias("n")).select("row", "n.*")
    # A term beside several entities is judged by the one it discloses most.
    worst = near.join(known, ["entity", "term"]).groupBy("row", "start", "end").agg(F.max("disclosure").alias("d"))
    kind = F.when(F.col("d") >= remove, REMOVED).otherwise(GENERALISED)
    added = worst.groupBy("row").agg(F.collect_list(F.struct(kind.alias("kind"), "start", "end")).alias("added"))
    order = F.array(*[F.lit(k) for k in ALL_KINDS])
    ranked = F.transform(
        F.concat("base", "added"), lambda s: F.struct(s["start"], F.array_position(order, s["kind"]).alias("at"), s["kind"], s["end"])
    )
    spans = F.transform(F.sort_array(ranked), lambda s: F.struct(s["kind"], s["start"], s["end"]))
    both = mentioned.join(added, "row", "left")
    return both.select("doc_id", "text_key", "base", F.when(F.col("added").isNull(), F.col("base")).otherwise(spans).alias("spans"))


def redact(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with ``sanitised``: the text with base spans and generalised terms replaced by their kind, others out.

    Spans belong to texts, so rows with the same text share them. A NULL text stays NULL.
    """
    spans = found.where("text_key is not null").select("text_key", "spans").groupBy("text_key").agg(F.first("spans").alias("__spans"))
    keyed = clear_of(docs, "sanitised", "__spans", "__key").withColumn("__key", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    joined = in_small_batches(keyed.join(spans, F.col("__key") == F.col("text_key"), "left"))
    whole = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(_without("text", "__spans"))
    return joined.withColumn("sanitised", whole).drop("__key", "text_key", "__spans")


def text_key(text: str) -> str:
    return hashlib.md5(text.encode("utf-8", "replace"), usedforsecurity=False).hexdigest()


def shape(term: str) -> str:
    """What a generalised term says: a number, a name (capitalised) or a word."""
    return "[number]" if term.isdigit() else "[name]" if term[:1].isupper() else "[word]"


def sanitised(text: str, spans) -> str:
    """``text`` without its spans; where spans overlap, the one that starts first speaks for them all."""
    parts, done = [], 0
    for span in () if spans is None else spans:
        kind, start, end = span["kind"], span["start"], span["end"]
        if start >= done:
            parts.append(text[done:start])
            parts.append("" if kind == REMOVED else shape(text[start:end]) if kind == GENERALISED else f"[{kind}]")
        done = max(done, end)
    return "".join([*parts, text[done:]])


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else sanitised(t, s) for t, s in zip(texts, spans)])
