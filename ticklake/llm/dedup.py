"""Operator 2: exact dedup in two Bloom-filter passes.

Pass 1 reads eight-byte hashes only.  They are dealt out by value, each task
runs its share through a Bloom filter, and a hash that the filter has met
before is *possibly repeated*.  Those hashes set bits in one filter of a
fixed size.  Pass 2 looks every row up in that filter: rows that miss are
unique and pass straight through; only the others are shuffled, by SHA-256
of the normalised text, and settled exactly.

The broadcast filter has ``bits`` bits whatever the input; a filter that is
too small for the number of repeated texts lets more rows into the exact
stage and changes no result.  A text that a third of all rows share is
reduced to two hashes per batch before pass 1 shuffles, and to one row per
task when the group is summed up.

Defined results: null text counts as empty; a null id is larger than all
others; of rows equal in text and id, one stays; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.arrow import bounded
from ticklake.session import materialize

SPACE = r"[\x20\x09-\x0D]+"
PROBES = 4
BITS = 1 << 25
#: 64-bit words of the filter of ``possibly_in``.
WORDS = 1 << 19


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def positions(hashes: np.ndarray, bits: int, probes: int = PROBES) -> np.ndarray:
    """The bits of each hash, as rows of ``probes`` numbers under ``bits``
    (a power of two): double hashing on the halves of the hash."""
    h = hashes.astype(np.uint64, copy=False)
    step = (h >> np.uint64(32)) | np.uint64(1)
    at = h[:, None] + step[:, None] * np.arange(probes, dtype=np.uint64)[None, :]
    at ^= at >> np.uint64(29)
    return at & np.uint64(bits - 1)


class Bloom:
    """A Bloom filter over 64-bit hashes: a byte for each of its bits while
    hashes are added, or the bits of ``data``, packed, to look hashes up."""

    def __init__(self, bits: int, data: np.ndarray | None = None):
        self.bits, self.data = bits, data
        self.flags = np.zeros(bits, np.uint8) if data is None else None

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = positions(hashes, self.bits).view(np.int64)
        if self.data is None:
            return self.flags[at].all(axis=1)
        return (self.data[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=1)

    def add(self, hashes: np.ndarray) -> None:
        self.flags[positions(hashes, self.bits).view(np.int64).ravel()] = 1


def _hashes(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("hash").to_numpy(zero_copy_only=False).view(np.uint64)


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At most two of each hash per batch: enough to show that it repeats."""
    for b in batches:
        values, counts = np.unique(_hashes(b), return_counts=True)
        yield pa.RecordBatch.from_pydict(
            {"hash": pa.array(np.concatenate([values, values[counts > 1]]).view(np.int64))})


def _words(at: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"word": pa.array((at >> np.uint64(6)).astype(np.int64)),
                                       "bit": pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))})


def _gathered(words: DataFrame, bits: int) -> np.ndarray:
    """The filter of all (word, bit) rows: ``bits`` bits on the driver."""
    got = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    data = np.zeros(bits // 64, np.int64)
    data[got["word"].to_numpy()] = got["bits"].to_numpy()
    return data.view(np.uint8)


def filter_of(keys: DataFrame, bits: int = BITS) -> np.ndarray:
    """A filter of ``bits`` bits with every value of ``hash`` in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _words(np.unique(positions(_hashes(b), bits)))
    return _gathered(keys.select("hash").mapInArrow(run, "word long, bit long"), bits)


def _repeated(bits: int, hashes_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = Bloom(bits)
        for hashes in hashes_of(batches):
            values, counts = np.unique(hashes, return_counts=True)
            again = met.has(values) | (counts > 1)
            met.add(values)
            yield _words(np.unique(positions(values[again], bits)))
    return run


def repeated_filter(keys: DataFrame, bits: int = BITS) -> np.ndarray:
    """Pass 1: ``bits`` bits, those of every value of ``hash`` that occurs
    more than once set (and a few more).  The driver receives the filter
    alone, of a fixed size."""
    dealt = keys.select("hash").mapInArrow(_collapse, "hash long").repartition("hash")
    return filter_of_repeated(dealt, partial(map, _hashes), bits)


def filter_of_repeated(dealt: DataFrame, hashes_of, bits: int = BITS) -> np.ndarray:
    """The same, of rows already dealt out so that equal hashes are in one
    task.  ``hashes_of``: batches of rows to arrays of hashes."""
    return _gathered(dealt.mapInArrow(_repeated(bits, hashes_of), "word long, bit long"), bits)


def _look_up(filter_, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Bloom(bits, filter_.value)
        for b in batches:
            yield b.append_column("maybe", pa.array(seen.has(_hashes(b)))).drop_columns("hash")
    return run


def possibly_repeated(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """``rows`` with ``maybe`` in place of ``hash``: false only where no
    other row has the same hash."""
    found = rows.sparkSession.sparkContext.broadcast(repeated_filter(rows, bits))
    rest = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "hash"]
    return rows.mapInArrow(_look_up(found, bits), ", ".join([*rest, "maybe boolean"]))


def possibly_in(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` with ``maybe``: false only where the hash ``doc`` (null: 0)
    is not in ``keys``.  The filter has at most ``WORDS`` rows."""
    at = F.pmod(F.coalesce("doc", F.lit(0)), F.lit(64 * WORDS))
    word, bit = F.floor(at / 64), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))
    bits = materialize(keys.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")), "possible_documents")
    rows = rows.withColumn("word", word).join(F.broadcast(bits), "word", "left").drop("word")
    return rows.withColumn("maybe", F.coalesce(F.col("bits").bitwiseAND(bit) != 0, F.lit(False))).drop("bits")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (),
                bits: int = BITS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id`` (id of the row
    that stays), ``group_size``, ``kept``, ``text_sha256`` and the columns
    named in ``carry``.  Without ``carry`` texts are read once and never
    shuffled; with it the carried columns of candidates are shuffled."""
    digest = bounded(docs).select(F.col(f"`{id_col}`").alias("doc_id"),
                         F.sha2(normalised(F.col(f"`{text_col}`")), 256).alias("text_sha256"),
                         *[F.col(f"`{c}`").alias(f"c_{c}") for c in carry])
    if not carry:
        digest = materialize(digest, "digests")
    rows = digest.withColumn("hash", F.xxhash64("text_sha256"))
    names = digest.columns
    checked = possibly_repeated(rows, bits)

    single = checked.filter(~F.col("maybe")).select(
        *names, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    several = materialize(checked.filter("maybe").drop("maybe")
                          .withColumn("row", F.monotonically_increasing_id()), "possibly_repeated")
    stays = materialize(several.groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")), "groups")
    settled = several.join(stays, "text_sha256").select(
        *names, F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"))
    out = single.unionByName(settled)
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256",
                      *[F.col(f"`c_{c}`").alias(c) for c in carry])
