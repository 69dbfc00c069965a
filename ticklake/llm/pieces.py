"""Operator 8: SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is read field by field.  What it holds is rebuilt as a
tokenizers pipeline: the normaliser (precompiled character map if there is
one, extra white space, the leading mark), the metaspace mark, the pieces
with their scores (a unigram model takes the scores as they are; a BPE model
ranks its merges by them), user-defined pieces, and byte fallback.  Batches
are encoded by as many threads as a task has cores.  ``parity`` compares
the result with the sentencepiece library text by text.

The pieces of the public model hold the mark at their start or are runs of
it, so the words of a text without runs of spaces are independent, and words
recur: a dictionary keeps the ids of up to ``limit`` of them.

Defined results: a null or empty text has no ids and decodes to an empty
text; every input row gives one row; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.arrow import bounded

MARK = "▁"
# Fixed values of the public sentencepiece_model.proto: piece types.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class PieceModel:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unknown: int = 0
    char_map: bytes = b""
    dummy_prefix: bool = True
    single_spaces: bool = True
    escape: bool = True


def fields(data: bytes) -> Iterator[tuple[int, int | bytes | float]]:
    """(number, value) of each field of a protobuf message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        elif kind == 2:
            size = number()
            yield tag >> 3, data[at:at + size]
            at += size
        elif kind == 5:
            yield tag >> 3, struct.unpack("<f", data[at:at + 4])[0]
            at += 4
        elif kind == 1:
            yield tag >> 3, struct.unpack("<d", data[at:at + 8])[0]
            at += 8
        else:
            raise ValueError(f"unknown wire type {kind}")


def read_model(path: str) -> PieceModel:
    with open(path, "rb") as f:
        data = f.read()
    m = PieceModel()
    for n, value in fields(data):
        if n == 1:  # a piece: text, score, type
            text, score, kind = "", 0.0, NORMAL
            for k, v in fields(value):
                if k == 1:
                    text = v.decode()
                elif k == 2:
                    score = v
                elif k == 3:
                    kind = v
            m.pieces.append((text, score, kind))
        elif n == 2:  # the trainer's settings
            for k, v in fields(value):
                if k == 3:
                    m.kind = v
                elif k == 35:
                    m.byte_fallback = bool(v)
                elif k == 40:
                    m.unknown = v
        elif n == 3:  # the normaliser's settings
            for k, v in fields(value):
                if k == 2:
                    m.char_map = v
                elif k == 3:
                    m.dummy_prefix = bool(v)
                elif k == 4:
                    m.single_spaces = bool(v)
                elif k == 5:
                    m.escape = bool(v)
    if m.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are rebuilt")
    return m


def merges_of(vocab: dict[str, int], rank: dict[str, float]) -> list[tuple[str, str]]:
    """All ways to join two pieces into one: the best score first, of equal
    scores (the runs of marks) the piece that the model lists first."""
    found = []
    for piece in rank:
        for i in range(1, len(piece)):
            a, b = piece[:i], piece[i:]
            if a in vocab and b in vocab and (len(a) == 1 or a in rank) and (len(b) == 1 or b in rank):
                found.append((-rank[piece], vocab[piece], vocab[a], a, b))
    return [(a, b) for *_, a, b in sorted(found)]


def build(m: PieceModel):
    """The tokenizers pipeline of a model, without its pre-tokeniser's
    leading mark (see ``Pieces``)."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers
    unk = m.pieces[m.unknown][0]
    if m.kind == UNIGRAM:
        model = models.Unigram([(p, s) for p, s, _ in m.pieces], unk_id=m.unknown, byte_fallback=m.byte_fallback)
    else:
        vocab = {p: i for i, (p, _, _) in enumerate(m.pieces)}
        rank = {p: s for p, s, k in m.pieces if k in (NORMAL, USER)}
        model = models.BPE(vocab, merges_of(vocab, rank), unk_token=unk, fuse_unk=True, byte_fallback=m.byte_fallback)
    t = Tokenizer(model)
    steps = []
    if m.char_map:
        steps.append(normalizers.Precompiled(m.char_map))
    if m.single_spaces:
        steps.append(normalizers.Replace(Regex(" {2,}"), " "))
    if m.escape:
        steps.append(normalizers.Replace(" ", MARK))
    t.normalizer = normalizers.Sequence(steps)
    t.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
    user = [AddedToken(p, normalized=False, special=False) for p, _, k in m.pieces if k == USER]
    if user:
        t.add_tokens(user)
    return t


class Pieces:
    """Encodes and decodes batches of texts."""

    #: Words of one string that is encoded for the dictionary.
    JOINED = 64

    def __init__(self, path: str, limit: int = 300_000):
        self.model = read_model(path)
        self.limit, self.known = limit, {}
        names = [(p, k) for p, _, k in self.model.pieces]
        #: Words are independent if no piece reaches past a mark: marks stand
        #: at a piece's start, alone or before one word, or make up a run.
        inner = any(MARK in p[1:] and p.strip(MARK) for p, k in names if k in (NORMAL, USER))
        self.by_word = (self.model.kind == BPE and self.model.escape and self.model.byte_fallback and not inner
                        and not self.model.char_map and all(k != USER for _, k in names))
        self.starts = np.array([p.startswith(MARK) for p, _ in names])
        self.bytes = [bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(MARK, " ").encode() for p, k in names]
        self.special = [k in (UNKNOWN, CONTROL, UNUSED) for _, k in names]

    @cached_property
    def tokenizer(self):
        """Built when first needed: decoding seldom is."""
        return build(self.model)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _marked(self, text: str) -> str:
        """Text as the model sees it, marks as spaces."""
        if self.model.single_spaces:
            text = re.sub(" {2,}", " ", text.strip(" "))
        return " " + text if text and self.model.dummy_prefix else text

    def _learn(self, words: list[bytes]) -> None:
        """Ids of words, each after one space: many are encoded as one
        string and parted where a piece starts with the mark."""
        groups = [words[i:i + self.JOINED] for i in range(0, len(words), self.JOINED)]
        for group, ids in zip(groups, self._whole([" " + b" ".join(g).decode() for g in groups])):
            at = np.flatnonzero(self.starts[ids])
            if len(at) != len(group):
                raise ValueError("a word was not one run of pieces")
            for w, a, b in zip(group, at, [*at[1:], len(ids)]):
                self.known[w] = ids[a:b].tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each whole text."""
        marked = [self._marked(t) for t in texts]
        if not self.by_word:
            return self._whole(marked)
        if len(self.known) > self.limit:
            self.known.clear()
        data = [t.replace(MARK, " ").encode() for t in marked]
        # runs of spaces are pieces of their own: such texts go whole
        plain = [d[:1] == b" " and d[-1:] != b" " and b"  " not in d for d in data]
        words = [d[1:].split(b" ") if p else [] for d, p in zip(data, plain)]
        new = set().union(*words).difference(self.known)
        if new:
            self._learn(list(new))
        rest = iter(self._whole([t for t, p in zip(marked, plain) if not p]))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, w)), np.int32) if p else next(rest)
                for w, p in zip(words, plain)]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """Text of each list of ids: the pieces' bytes, and the library for
        lists with control pieces or bytes that are not UTF-8."""
        out = []
        for x in ids:
            x = x.tolist() if isinstance(x, np.ndarray) else x
            try:
                if any(map(self.special.__getitem__, set(x))):
                    raise UnicodeError
                text = b"".join(map(self.bytes.__getitem__, x)).decode()
            except UnicodeError:
                text = self.tokenizer.decode(x, skip_special_tokens=False)
            out.append(text[1:] if self.model.dummy_prefix and text.startswith(" ") else text)
        return out


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    """One per Python worker."""
    return Pieces(path)


def public_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _threads(n: int) -> None:
    os.environ["RAYON_NUM_THREADS"] = str(n)


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]), pa.int32()))


def _encode(path: str, threads: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _threads(threads)
        model = pieces_of(path)
        for b in batches:
            for first in range(0, b.num_rows, 512):
                part = b.slice(first, 512)
                ids = model.encode([t or "" for t in part.column("text").to_pylist()])
                yield part.append_column("ids", _lists(ids))
    return run


def _encode_checked(path: str, threads: int):
    """Ids of ``text``, and whether they decode to it, in one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _threads(threads)
        model = pieces_of(path)
        for b in batches:
            for first in range(0, b.num_rows, 512):
                part = b.slice(first, 512)
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids = model.encode(texts)
                same = [a == t.replace(MARK, " ") for a, t in zip(model.decode(ids), texts)]
                yield part.drop_columns("text").append_column("ids", _lists(ids)).append_column("round_trip", pa.array(same))
    return run


def _decode(path: str, threads: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _threads(threads)
        model = pieces_of(path)
        for b in batches:
            for first in range(0, b.num_rows, 512):
                part = b.slice(first, 512)
                ids = [np.zeros(0, np.int32) if not x.is_valid else x.values.to_numpy(zero_copy_only=False) for x in part.column("ids")]
                yield part.append_column("decoded", pa.array(model.decode(ids), pa.string()))
    return run


def _with(df: DataFrame, name: str, source: str, out: str, kind: str, fn) -> DataFrame:
    """``df`` and one more column that ``fn`` makes of ``source``."""
    names = [c for c in df.columns if c != out]
    plain = bounded(df).select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(f"`{source}`").alias(name))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields)
    made = plain.mapInArrow(fn, f"{schema}, {kind}")
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], F.col(kind.split()[0]).alias(out))


def encode(df: DataFrame, model: str | None = None, text_col: str = "text", out: str = "ids", threads: int = 1) -> DataFrame:
    """``df`` with ``out``: the ids of each whole text.  ``threads``: of a
    batch; set it to spark.task.cpus."""
    return _with(df, "text", text_col, out, "ids array<int>", _encode(model or public_model(), threads))


def encode_checked(df: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text", threads: int = 1) -> DataFrame:
    """``doc_id``, ``ids`` and ``round_trip``: whether the ids decode to the
    text (marks read as spaces)."""
    two = bounded(df).select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = two.schema["doc_id"].dataType.simpleString()
    return two.mapInArrow(_encode_checked(model or public_model(), threads), f"doc_id {kind}, ids array<int>, round_trip boolean")


def decode(df: DataFrame, model: str | None = None, ids_col: str = "ids", out: str = "decoded", threads: int = 1) -> DataFrame:
    """``df`` with ``out``: the text of each list of ids."""
    return _with(df, "ids", ids_col, out, "decoded string", _decode(model or public_model(), threads))


def parity(texts: list[str], model: str | None = None) -> list[int]:
    """Numbers of the texts whose ids or decoded text differ from those of
    the sentencepiece library."""
    import sentencepiece
    path = model or public_model()
    theirs, ours = sentencepiece.SentencePieceProcessor(model_file=path), Pieces(path)
    want = theirs.encode(texts, num_threads=1)
    have = ours.encode(texts)
    return [i for i, (a, b, c, d) in enumerate(zip(want, have, theirs.decode(want), ours.decode(have))) if a != b.tolist() or c != d]
