"""Operator 10: language identification by error-correcting output codes.

Every language gets a codeword, and for each of its bits a linear classifier
over hashed letter n-grams (1 to 3 letters) is trained to predict that bit.
A text's language is the codeword of least logistic loss over the bits'
margins, so bits that are sure weigh more than bits that are not.  Texts
whose best two codewords are close are flagged as ambiguous.

Training reads a bounded sample: at most ``per_language`` documents of each
language, those of the smallest hash of their id, each turned into n-gram
counts by Spark tasks; the driver receives those counts only and fits the
bits.  Prediction is a narrow map over whole texts, read in slices of bounded
length whose counts add up to those of the uncut text.

Defined results: a null text, or one without a letter, is ``und`` with score
0; with no training rows everything is ``und``; a null id is held out or not
like any other (its remainder is null: not held out); repeated rows are
predicted each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.arrow import bounded

UNKNOWN = "und"
BUCKETS = 1 << 13
PER_LANGUAGE = 400
SLICE = 1 << 20
SPACE = 32


@dataclass(frozen=True)
class Model:
    """``weights``: buckets x bits; ``codes``: languages x bits of -1, 1."""

    languages: tuple[str, ...]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """``n`` codewords of -1 and 1.  Up to six languages: the exhaustive
    code, every way to split the languages in two.  Beyond: of many random
    codes of 8 log2(n) bits, the one whose nearest pair is farthest apart."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        bits = [[1 if (b >> i) & 1 or i == 0 else -1 for i in range(n)] for b in range(0, 1 << n, 2)]
        return np.array([b for b in bits if -1 in b], float).T
    rng, size, best, far = np.random.default_rng(seed), 8 * int(np.ceil(np.log2(n))), None, -1
    for _ in range(200):
        c = rng.choice([-1.0, 1.0], (n, size))
        gap = ((size - c @ c.T) / 2 + np.eye(n) * size).min()
        split = (abs(c.sum(axis=0)) < n).all()
        if split and gap > far:
            best, far = c, gap
    return best


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """True at every code point that is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letters(text: str) -> np.ndarray:
    """Code points of a text in lower case; each run of others than letters
    becomes one space."""
    a = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    a = np.where(letter_table()[a], a, SPACE)
    keep = np.ones(len(a), bool)
    keep[1:] = (a[1:] != SPACE) | (a[:-1] != SPACE)
    return a[keep].astype(np.uint64)


def _mix(x: np.ndarray, buckets: int) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(40)) & np.uint64(buckets - 1)).astype(np.int64)


def _grams_ending_in(new: np.ndarray, seen: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of the n-grams that end in ``new``; ``seen``: the one or two
    code points before it."""
    a, k = np.concatenate([seen, new]), len(seen)
    two = (a[k - 1:-1] << np.uint64(21)) | a[k:]
    three = (a[:-2] << np.uint64(42)) | (a[1:-1] << np.uint64(21)) | a[2:]
    one = new[new != SPACE]
    return _mix(np.concatenate([one, two | np.uint64(1 << 63), three]), buckets)


def counts(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Counts of the n-grams of the whole text, read in slices of bounded
    length.  A slice starts from the two code points before it, so the
    slices' counts add up to those of the uncut text."""
    total = np.zeros(buckets)
    low, seen = text.lower(), np.array([SPACE], np.uint64)
    for at in range(0, len(low), SLICE):
        new = letters(low[at:at + SLICE])
        if at and seen[-1] == SPACE and new[0] == SPACE:  # a run of others goes on
            new = new[1:]
        if at + SLICE >= len(low):
            new = np.append(new, np.uint64(SPACE))
        if len(new):
            total += np.bincount(_grams_ending_in(new, seen, buckets), minlength=buckets)
            seen = np.concatenate([seen, new])[-2:]
    return total


def _scaled(x: np.ndarray) -> np.ndarray:
    """Square roots of counts, to unit length."""
    x = np.sqrt(x)
    norm = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _count_rows(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, n = [], []
            for t in b.column("text"):
                c = counts(t.as_py(), buckets)
                at.append(np.flatnonzero(c).astype(np.int32))
                n.append(c[at[-1]].astype(np.float32))
            yield pa.RecordBatch.from_pydict({
                "lang": b.column("lang"), "h": b.column("h"), "at": pa.array(at, pa.list_(pa.int32())), "n": pa.array(n, pa.list_(pa.float32()))})
    return run


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE, buckets: int = BUCKETS, steps: int = 150) -> Model:
    """Fits the bits on the labelled rows.  Bound: about
    ``per_language`` rows of each language, in all at most twice as many;
    ``buckets`` counts a row."""
    known = bounded(rows).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                        F.col(f"`{lang_col}`").alias("lang")).filter("lang is not null and text is not null")
    total = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = tuple(sorted(total))
    if not languages:
        return Model((), np.zeros((0, 1)), np.zeros((buckets, 1)), np.zeros(1))
    known = known.withColumn("h", F.xxhash64(F.col("id").cast("string")))
    share = F.lit(False)
    for lang in languages:  # hashes are even: those under the share's quantile are about per_language rows
        top = -2.0 ** 63 + 2.0 ** 64 * min(1.0, per_language / total[lang])
        share = share | ((F.col("lang") == lang) & (F.col("h").cast("double") <= top))
    got = known.filter(share).select("lang", "h", "text").mapInArrow(
        _count_rows(buckets), "lang string, h long, at array<int>, n array<float>")
    got = got.limit(2 * per_language * len(languages)).toArrow().sort_by([("lang", "ascending"), ("h", "ascending")])
    langs = got["lang"].to_pylist()
    x = np.zeros((len(langs), buckets), np.float32)
    for i, (at, n) in enumerate(zip(got["at"], got["n"])):
        x[i, at.values.to_numpy()] = n.values.to_numpy()
    x = _scaled(x).astype(np.float32)
    codes = codewords(len(languages))
    y = codes[[languages.index(v) for v in langs]]
    weight = np.array([1.0 / langs.count(v) for v in languages])[[languages.index(v) for v in langs]]
    weight = (weight / weight.sum())[:, None]
    w, b = np.zeros((buckets, codes.shape[1]), np.float32), np.zeros(codes.shape[1])
    step_w, step_b = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):  # gradient descent with momentum on the logistic loss
        pull = weight * y / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30)))
        step_w = 0.9 * step_w + 4.0 * (x.T @ pull - 1e-5 * w)
        step_b = 0.9 * step_b + 0.4 * pull.sum(axis=0)
        w, b = (w + step_w).astype(np.float32), b + step_b
    return Model(languages, codes, w, b)


def decode(model: Model, margins: np.ndarray) -> tuple[str, float, float]:
    """Language, score and lead over the next: softmax of minus the loss
    of each codeword."""
    loss = np.logaddexp(0, -model.codes * margins[None, :]).sum(axis=1)
    p = np.exp(loss.min() - loss)
    p /= p.sum()
    order = np.argsort(-p, kind="stable")
    second = p[order[1]] if len(order) > 1 else 0.0
    return model.languages[order[0]], float(p[order[0]]), float(p[order[0]] - second)


def _predict(shared, lead: float, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for b in batches:
            pred, score, unsure = [], [], []
            for t in b.column("text"):
                got = (UNKNOWN, 0.0, 0.0)
                text = t.as_py()
                if text is not None and model.languages and has_letter(text):
                    got = decode(model, margins_of(model, text))
                pred.append(got[0])
                score.append(got[1])
                unsure.append(got[2] < lead)
            rest = b if keep_text else b.drop_columns("text")
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())],
                [*rest.schema.names, "lang_pred", "score", "ambiguous"])
    return run


def margins_of(model: Model, text: str) -> np.ndarray:
    """The bits' margins for a whole text."""
    return _scaled(counts(text, len(model.weights))) @ model.weights + model.bias


def predict(docs: DataFrame, model: Model, lead: float = 0.1, text_col: str = "text",
            carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``carry`` with ``lang_pred``, ``score`` (0 to 1) and
    ``ambiguous`` (its lead over the next language is under ``lead``).
    Labels and ids take no part."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = {c: "text" if c == text_col else f"c{i}" for i, c in enumerate(carry)}
    two = bounded(docs).select(*[F.col(f"`{c}`").alias(name) for c, name in at.items() if c != text_col],
                      F.col(f"`{text_col}`").alias("text"))
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in two.schema.fields if f.name != "text" or text_col in at]
    out = two.mapInArrow(_predict(shared, lead, text_col in at),
                         ", ".join([*kept, "lang_pred string, score double, ambiguous boolean"]))
    return out.select(*[F.col(name).alias(c) for c, name in at.items()], "lang_pred", "score", "ambiguous")


def held_out(doc_id: Column) -> Column:
    """The rows kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
