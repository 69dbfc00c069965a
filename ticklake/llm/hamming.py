"""Pairs of 64-bit fingerprints within a few bits of each other.

Fingerprints that agree on the bits of a mask meet in one bucket.  A method
gives, for each of its *chains*, the masks of level 0 and, for each further
level, finer masks such that every pair that the chain stands for still
meets under one of them.  A bucket of at most ``full`` fingerprints is
compared inside one task; a larger one is dealt out again by the masks of
the next level, and the buckets of the last level are small by construction
(distinct fingerprints that may differ in a few given bits only).  No bucket
is cut, and no task receives an unbounded one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.session import materialize

FULL = 64
PAIRS_AT_ONCE = 1 << 19
KEY = ["chain", "mask", "value"]


@dataclass(frozen=True)
class Method:
    """``masks[level][chain]``: bits that a bucket's members share.
    ``check(x, chain)``: which differences ``x`` (xor) the chain keeps."""

    masks: Sequence[Sequence[Sequence[int]]]
    check: Callable[[np.ndarray, int], np.ndarray]


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def signed(mask: int) -> int:
    """The mask as a signed 64-bit number."""
    return mask - (1 << 64) if mask >> 63 else mask


def _spread(masks: Sequence[Sequence[int]]):
    """Rows of (chain, fp) to rows of (chain, mask, value, fp)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [np.array([signed(m) for m in chain], np.int64) for chain in masks]
        for whole in batches:
            for first in range(0, whole.num_rows, 2048):
                b = whole.slice(first, 2048)
                chains, fps = (b.column(c).to_numpy(zero_copy_only=False) for c in ("chain", "fp"))
                for c in np.unique(chains):
                    fp = fps[chains == c]
                    m = np.tile(table[c], len(fp))
                    fp = np.repeat(fp, len(table[c]))
                    yield pa.RecordBatch.from_pydict({"chain": pa.array(np.full(len(fp), c, np.int32)), "mask": pa.array(m),
                                                      "value": pa.array(fp & m), "fp": pa.array(fp)})
    return run


def parts_of(link: np.ndarray) -> np.ndarray:
    """For each of a stack of symmetric link matrices, the smallest member
    number that each member reaches."""
    g, s, _ = link.shape
    best = np.broadcast_to(np.arange(s, dtype=np.int32), (g, s)).copy()
    while True:
        near = np.where(link, best[:, None, :], np.int32(s)).min(axis=2)
        new = np.minimum(best, near)
        new = np.take_along_axis(new, new, axis=1)
        if (new == best).all():
            return best
        best = new


def _compare(check: Callable[[np.ndarray, int], np.ndarray]):
    def one(chain: int, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Members and the first of their part, for buckets of one size."""
        g, s = m.shape
        i, j = np.triu_indices(s, 1)
        link = np.zeros((g, s, s), bool)
        link[:, i, j] = check((m[:, i] ^ m[:, j]).view(np.uint64), chain)
        link |= link.transpose(0, 2, 1)
        root = parts_of(link)
        at, k = np.nonzero(root != np.arange(s))
        return m[at, k], m[at, root[at, k]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("fps")
            chains, sizes = b.column("chain").to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
            flat, start = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)])
            for chain, size in sorted(set(zip(chains.tolist(), sizes.tolist()))):
                rows = np.flatnonzero((chains == chain) & (sizes == size))
                step = max(1, PAIRS_AT_ONCE // (size * size))
                for first in range(0, len(rows), step):
                    x, y = one(chain, flat[start[rows[first:first + step], None] + np.arange(size)[None, :]])
                    yield pa.RecordBatch.from_pydict({"a": pa.array(x), "b": pa.array(y)})
    return run


def near_links(fps: DataFrame, method: Method, full: int = FULL) -> DataFrame:
    """``a``, ``b``: edges between values of ``fp`` (distinct longs) that
    join all pairs which some chain keeps.  Of each bucket's connected parts
    every member is given once, with the first member: edges grow with the
    members of buckets, never with their pairs."""
    found = None
    chains = F.explode(F.array(*[F.lit(c) for c in range(len(method.masks[0]))]))
    rows = fps.select(chains.alias("chain"), "fp")
    for level, masks in enumerate(method.masks):
        last = level == len(method.masks) - 1
        keyed = rows.mapInArrow(_spread(masks), "chain int, mask long, value long, fp long")
        sizes = materialize(keyed.groupBy(*KEY).count().filter("count > 1"), "bucket_sizes")
        met = materialize(keyed.join(sizes, KEY), "bucket_members")
        small = met if last else met.filter(F.col("count") <= full)
        # many small buckets in one task, compared together by size
        buckets = small.groupBy(*KEY).agg(F.collect_list("fp").alias("fps"))
        links = buckets.select("chain", "fps").mapInArrow(_compare(method.check), "a long, b long")
        found = links if found is None else found.unionByName(links)
        if last or sizes.filter(F.col("count") > full).isEmpty():
            break
        rows = materialize(met.filter(F.col("count") > full).select("chain", "fp").distinct(), "large_buckets")
    return found


EVERY_EIGHTH = np.uint64(0x0101010101010101)


def bit_sums(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each bit is set in each run of hashes.  ``hashes``: rows of
    64-bit words; ``starts``: first row of each run (none is empty).  Eight
    bits at a time, a byte apart, are counted in bytes, for up to 255 rows."""
    n, words = hashes.shape
    sizes = np.diff(np.append(starts, n))
    pieces = -(-sizes // 255)
    first = np.cumsum(pieces) - pieces
    cuts = np.repeat(starts, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(first, pieces))
    short = np.empty((len(cuts), words * 8, 8), np.uint8)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & EVERY_EIGHTH, cuts, axis=0)
        short[:, :, k] = lanes.view(np.uint8).reshape(len(cuts), words * 8)
    return np.add.reduceat(short.reshape(len(cuts), words * 64), first, axis=0, dtype=np.int64)
