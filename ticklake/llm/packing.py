"""Operator 3: packing by power-of-two decomposition.

Each document's tokens are cut into pieces whose lengths are powers of two,
the largest first, at most ``max_len``.  A piece is a sequence of its own:
no sequence crosses documents and none is padded.  ``bucket`` is the length,
so that batches of equal length can be drawn from one bucket.

Documents are independent, so packing is a narrow map: no shuffle, and a
lost task repeats only its own split.  Memory is bounded by one Arrow batch
and the word cache.

Defined results: a null or empty text is the end token alone (one piece of
length 1); null and repeated ids are packed row by row; an empty table gives
an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.arrow import bounded

MAX_LEN = 2048
END_ID = 1
PIECES = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long"


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


#: Words of Latin-1 letters, in lower case: they are one pre-token, and the
#: model's normaliser leaves them as they are.
PLAIN = re.compile("[a-zß-öø-ÿ]+")


def byte_characters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the characters from U+0100 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokenizer(dict):
    """Token ids by the tokenizers library, one chunk of text at a time:
    a dictionary from a chunk's bytes to its ids (little-endian 32 bits).

    The model's normaliser and pre-tokeniser never join text across white
    space, so the ids of a text are those of its chunks in order, and chunks
    recur.  Letters A-Z are lowered first, as the normaliser would.  Texts
    that hold one of the model's special strings go whole.
    """

    def __init__(self, path: str, limit: int = 700_000):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.words = self.whole.model
        self.table = byte_characters()
        self.special = [t.content.lower().encode() for t in self.whole.get_added_tokens_decoder().values()]
        self.limit = limit

    def _all(self, text: str) -> bytes:
        ids = self.whole.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, "<u4").tobytes()

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        low = text.lower()
        if PLAIN.fullmatch(low):
            mapped = low if low.isascii() else low.encode().decode("latin-1").translate(self.table)
            ids = np.array([t.id for t in self.words.tokenize(mapped)], "<u4").tobytes()
        elif len(chunk) > 1 and chunk[-1:] in b".," and PLAIN.fullmatch(low[-2]):
            ids = self[chunk[:-1]] + self[chunk[-1:]]
        else:
            ids = self._all(text)
        self[chunk] = ids
        return ids

    def ids(self, text: str) -> bytes:
        low = text.encode().lower()
        if any(s in low for s in self.special):
            return self._all(text)
        if len(self) > self.limit:
            self.clear()
        return b"".join(map(self.__getitem__, low.replace(b"\n", b" ").split(b" ")))


@lru_cache(maxsize=2)
def tokenizer_of(path: str) -> WordTokenizer:
    """One per Python worker: workers live through many tasks."""
    return WordTokenizer(path)


def cut(n: int, max_len: int = MAX_LEN) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: powers of two, none
    above ``max_len`` (a power of two itself)."""
    out = [(s, max_len) for s in range(0, n - n % max_len, max_len)]
    at, rest = n - n % max_len, n % max_len
    while rest:
        size = 1 << (rest.bit_length() - 1)
        out.append((at, size))
        at, rest = at + size, rest - size
    return out


def _pieces(path: str, max_len: int, end_id: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer_of(path)
        for b in batches:
            for first in range(0, b.num_rows, 512):
                yield one(words, b.slice(first, 512))

    def one(words: WordTokenizer, b: pa.RecordBatch) -> pa.RecordBatch:
        row, start, length, crc, total, ids = [], [], [], [], [], []
        for i, text in enumerate(b.column("text")):
            a = np.frombuffer(words.ids(text.as_py() or "") + end, "<u4")
            for s, n in cut(len(a), max_len):
                row.append(i)
                start.append(s)
                length.append(n)
                crc.append(zlib.crc32(a[s:s + n]))
                total.append(len(a))
                if with_ids:
                    ids.append(a[s:s + n].astype(np.int32))
        out = {"doc_id": b.column("doc_id").take(pa.array(row, pa.int64()))}
        for name, values in (("start", start), ("length", length), ("ids_crc32", crc), ("doc_tokens", total)):
            out[name] = pa.array(values, pa.int64())
        if with_ids:
            out["input_ids"] = pa.array(ids, pa.list_(pa.int32()))
        return pa.RecordBatch.from_pydict(out)
    return run


def pack(docs: DataFrame, tokenizer: str | None = None, max_len: int = MAX_LEN, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` (ids of the document before
    it), ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset`` (0: a piece fills its sequence), ``bucket`` and, unless
    ``with_ids`` is false, ``input_ids``.  ``tokenizer``: path of a
    tokenizers JSON file that every executor has."""
    if max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    path = tokenizer or public_path("word_bpe_49k.json")
    two = bounded(docs).select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = PIECES.format(id=two.schema["doc_id"].dataType.simpleString()) + (", input_ids array<int>" if with_ids else "")
    pieces = two.mapInArrow(_pieces(path, max_len, end_id, with_ids), schema)
    return pieces.select("*", F.monotonically_increasing_id().alias("sequence_id"),
                         F.lit(0).cast("long").alias("offset"), F.col("length").cast("int").alias("bucket"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Writes packed pieces with one folder per length, so that a training
    job reads batches of equal length."""
    pieces.write.partitionBy("bucket").parquet(path)
