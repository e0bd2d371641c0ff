"""Token ids of texts in a compressed, checksummed file format, written and read by Spark."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm import id_coder
from clickloom.llm.common import in_small_batches, running_totals
from clickloom.session import materialize

END_ID = 0
FRAME_IDS = 1 << 21
MEMO_PIECES = 700_000

# All letters below U+0100.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
RUNS = re.compile(f"[{LETTERS}]+|[^{LETTERS}]+")
WORD = re.compile(f"[{LETTERS}]+")
MARKS = ",.;:!?"
UNCUT = re.compile(r"[^\x00-\xff]|'|\s\s")
SPARE_BLANK = re.compile(r" (?:\s|\Z)")


class _Pieces(dict):
    """The ids of pieces of text, as bytes; a piece is encoded when it is first asked for.

    A key is a piece without the blank before it, or with one blank more where there is none. Of ``MEMO_PIECES``
    and as many older pieces, those not asked for lately are forgotten.
    """

    def __init__(self, tokenizer, added: list[str]):
        super().__init__()
        self.tokenizer, self.added = tokenizer, added
        self.words, self.tokenize = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize
        letters = [chr(c) for c in range(128, 256) if WORD.fullmatch(chr(c))]
        self.letters = {ord(c): self.words(c)[0][0] for c in letters}
        self.blank = self.words(" a")[0][0][:-1]
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        ids = self.older.pop(key, None)
        if ids is None:
            if not key.isascii():
                ids = self._ids(key)
            elif key.isalpha():
                ids = self._of_word(self.blank + key)
            elif key[-1] in MARKS and key[:-1].isalpha():
                ids = self[key[:-1]] + self[" " + key[-1]]
            else:
                ids = self._ids(key)
        self[key] = ids
        return ids

    def _of_word(self, word: str) -> bytes:
        return array("I", [t.id for t in self.tokenize(word)]).tobytes()

    def _ids(self, key: str) -> bytes:
        bare = key[:1] == " "
        text = key[1:] if bare else " " + key
        word = key[1:] if bare else key
        if WORD.fullmatch(word):
            word = word if word.isascii() else word.translate(self.letters)
            return self._of_word(word if bare else self.blank + word)
        if any(t in text for t in self.added):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if not UNCUT.search(text):
            # A letter beside another character begins or ends a word, but for those after an apostrophe.
            first, *rest = RUNS.findall(word) or [""]
            if rest:
                return self[key[:1] + first if bare else first] + b"".join([self[" " + r] for r in rest])
        return b"".join([self._of_word(word) for word, _ in self.words(text)])

    def age(self) -> None:
        if len(self) > MEMO_PIECES:
            self.older = dict(self)
            self.clear()


class TokenizerFile:
    """Encodes texts with a tokenizer file, each distinct piece of text once.

    A byte-level tokenizer that adds no prefix looks at a text's words one by one, each with the blank before
    it; cut before single blanks, the pieces have the same ids as in the whole text, and those of a word are the
    model's. Texts with a blank before white space or at the end, and other kinds of tokenizer, are encoded whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            kind = json.load(file)
        before, added = kind.get("pre_tokenizer") or {}, kind.get("added_tokens", ())
        self.in_pieces = (
            kind.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and before.get("use_regex", True)
            and not kind.get("truncation")
            and not kind.get("padding")
            and not any(t.get("lstrip") or t.get("rstrip") or " " in t["content"] for t in added)
            and not any(WORD.fullmatch(t["content"].strip(MARKS)) for t in added)
        )
        self.pieces = _Pieces(self.tokenizer, [t["content"] for t in added]) if self.in_pieces else None

    def encode_bytes(self, text: str) -> bytes:
        """The ids of a text, in 32 bits each and without an end id."""
        if not text:
            return b""
        if not self.in_pieces or SPARE_BLANK.search(text):
            (coded,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
            return array("I", coded.ids).tobytes()
        self.pieces.age()
        keys = text.split(" ")
        keys[0] = " " + keys[0]
        if len(keys[0]) == 1:
            del keys[0]
        return b"".join(map(self.pieces.__getitem__, keys))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, without an end id."""
        return [np.frombuffer(self.encode_bytes(t), np.uint32) for t in texts]


@lru_cache(maxsize=1)
def _tokenizer_file(path: str, changed: int) -> TokenizerFile:
    """A worker keeps its tokenizer, with the pieces known, from task to task."""
    return TokenizerFile(path)


def _frame(doc_ids: list, ids: list[bytes], schema: pa.Schema) -> pa.RecordBatch:
    """One file row: whole documents, and their ids cut into blocks."""
    flat = np.frombuffer(b"".join(ids), np.uint32)
    blocks = id_coder.encode(np.array_split(flat, max(1, len(flat) // FRAME_IDS)))
    values = [[doc_ids], [[len(x) // 4 for x in ids]], [blocks]]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)


def _written(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, schema = _tokenizer_file(path, os.stat(path).st_mtime_ns), None
        end = np.uint32(end_id).tobytes()
        docs, ids, held = [], [], 0
        for batch in batches:
            schema = pa.schema(
                [
                    ("doc_ids", pa.list_(batch.schema.field("doc_id").type)),
                    ("counts", pa.list_(pa.int64())),
                    ("blocks", pa.list_(pa.binary())),
                ]
            )
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                docs.append(name)
                ids.append(coder.encode_bytes(text or "") + end)
                held += len(ids[-1]) // 4
                if held >= FRAME_IDS:
                    yield _frame(docs, ids, schema)
                    docs, ids, held = [], [], 0
        if docs:
            yield _frame(docs, ids, schema)

    return run


def write_ids(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Encode texts, append ``end_id`` to each, and write them in ascending order of doc_id; the files' rows.

    Files follow each other in id order; a row holds a run of whole documents: their ids, their lengths and
    the coded blocks. Blocks are independent and checksummed. The container is Parquet, written by Spark, so
    that a lost task leaves no half file. NULL texts are empty (only the end id); NULL ids come first.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    # Rows with one id are spread by their place; their order among themselves does not matter.
    placed = in_small_batches(docs).select("doc_id", "text", F.monotonically_increasing_id().alias("place"))
    by = [F.col("doc_id").asc_nulls_first(), F.col("place").asc()]
    ordered = placed.repartitionByRange(*by).sortWithinPartitions(*by).select("doc_id", "text")
    rows = ordered.mapInArrow(
        _written(tokenizer_path, end_id), f"doc_ids array<{id_type}>, counts array<bigint>, blocks array<binary>"
    )
    return materialize(rows, "token-ids")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, counts, blocks = (batch.column(c) for c in ("doc_ids", "counts", "blocks"))
        for i in range(batch.num_rows):
            sizes = counts[i].as_py()
            decoded = id_coder.decode(blocks[i].as_py())
            flat = np.concatenate(decoded).astype("<u4") if decoded else np.empty(0, "<u4")
            if len(flat) != sum(sizes):
                raise ValueError("blocks are missing")
            stops = np.cumsum(sizes)
            own = [flat[stop - n : stop].tobytes() for stop, n in zip(stops.tolist(), sizes)]
            yield pa.RecordBatch.from_arrays(
                [names[i].values, pa.array(sizes, pa.int64()), pa.array(own, pa.binary())],
                ["doc_id", "n_tokens", "ids"],
            )


def read_ids(rows: DataFrame) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian 32 bit) of every document in the files; checksums are verified."""
    id_type = rows.schema["doc_ids"].dataType.elementType.simpleString()
    return rows.mapInArrow(_read, f"doc_id {id_type}, n_tokens long, ids binary")


def with_starts(read: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32: where each document's ids begin in the whole sequence."""
    digest = read.select("doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return running_totals(digest, ["doc_id"], {"start": "n_tokens"}, "id-starts").select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )
