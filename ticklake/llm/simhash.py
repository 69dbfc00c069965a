"""Operator 5: SimHash near-dedup with a pigeonring filter.

A document's fingerprint has a bit set where more than half of its shingles'
hashes have it.  Fingerprints within ``distance`` bits link.

The 64 bits are a ring of segments.  If two fingerprints differ in at most
``distance`` bits, some segment starts a chain whose every prefix of l
segments differs in at most l * distance / segments bits (pigeonring
principle).  The first segments of such a chain, those whose budget is below
one bit, must agree exactly: they are the bucket.  Members of a bucket are
compared segment by segment along the chain, and a pair is dropped as soon as
its running difference leaves the budget; what reaches the end of the ring
has passed the full Hamming check.  Buckets that are too large are dealt out
again by the next budget: the segments that may hold one difference, with
one bit left open in turn, and so on.

Equal fingerprints are one node, so copies never meet as pairs.

Defined results: null text counts as empty; a text without words has
fingerprint zero and links like any other; null ids belong to their group
and are never its smallest; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.arrow import bounded
from ticklake.llm.components import connected_components
from ticklake.llm.hamming import Method, bit_sums, near_links, popcount
from ticklake.session import materialize

SHINGLE = 3
DISTANCE = 2
SEED = 42
CHUNK = 1 << 15


def majority(hashes: Iterator[int], n: int) -> int:
    """Bits set in over half of ``n`` 64-bit hashes."""
    total, left = np.zeros(64, np.int64), n
    while left:
        part = np.fromiter(hashes, np.uint64, min(left, CHUNK))
        total += bit_sums(part[:, None], np.zeros(1, np.int64))[0]
        left -= len(part)
    return int(np.packbits(total * 2 > n, bitorder="little").view(np.uint64)[0])


_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a whole text, an unsigned 64-bit number."""
    words = (text or "").encode().lower().split()  # ASCII letters and white space only
    if not words:
        return 0
    if len(words) <= shingle:
        return majority(map(_hash, [b" ".join(words)]), 1)
    rows = zip(*[words[i:] for i in range(shingle)])
    return majority(map(_hash, map(b" ".join, rows)), len(words) - shingle + 1)


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = np.array([fingerprint(t.as_py(), shingle) for t in b.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.drop_columns("text").columns, pa.array(made)],
                                             [*b.drop_columns("text").schema.names, "fp"])
    return run


def _bits(segments: list[list[int]]) -> int:
    return sum(1 << b for s in segments for b in s)


def pigeonring(distance: int) -> Method:
    """Chains over a ring of 4 segments for each bit of ``distance``, 8 at
    least: with two bits or more the bucket is 3 segments, and each further
    level opens one bit more.  Meant for small distances: the masks of the
    last level are the choices of ``distance - 1`` bits."""
    m = min(64, max(8, 4 * distance))
    edges = [round(64 * i / m) for i in range(m + 1)]
    ring = [list(range(edges[i], edges[i + 1])) for i in range(m)]
    budget = [length * distance // m for length in range(1, m + 1)]
    prefix, masks = [], [[] for _ in range(distance)]
    for start in range(m):
        chain = [ring[(start + i) % m] for i in range(m)]
        prefix.append(np.array([_bits(chain[:n + 1]) for n in range(m)], np.uint64))
        exact = chain[:budget.count(0)]
        for level in range(distance):  # as long as the budget stays at ``level``
            part = chain[:sum(x <= level for x in budget)]
            loose = [b for s in part[len(exact):] for b in s]
            masks[level].append([_bits(part) & ~sum(1 << b for b in gone) for gone in combinations(loose, level)])

    def check(x: np.ndarray, start: int) -> np.ndarray:
        ok = np.ones(x.shape, bool)
        for bits, most in zip(prefix[start], budget):
            ok &= popcount(x & bits) <= most
        return ok

    return Method(masks, check)


def version(text: Column) -> Column:
    """A hash that tells the texts of one id apart (null: 0)."""
    return F.coalesce(F.xxhash64(text), F.lit(0))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``doc`` (hash of its text), ``fp``
    (signed long), ``part`` (a fingerprint that names its group) and
    ``component_id``, the smallest id reachable over links."""
    text = F.col(f"`{text_col}`")
    two = bounded(docs).select(F.col(f"`{id_col}`").alias("doc_id"), version(text).alias("doc"), text.alias("text"))
    kind = two.schema["doc_id"].dataType.simpleString()
    marked = materialize(two.mapInArrow(_fingerprints(shingle), f"doc_id {kind}, doc long, fp long"), "fingerprints")
    groups = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint_groups")
    if distance <= 0:
        named = groups.select("fp", F.col("fp").alias("part"), F.col("least").alias("component_id"))
    else:
        links = near_links(groups.select("fp"), pigeonring(distance))
        parts = materialize(connected_components(links).select(F.col("node").alias("fp"), "component"), "parts")
        joined = groups.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
        joined = materialize(joined, "fingerprint_parts")
        first = materialize(joined.groupBy("component").agg(F.min("least").alias("component_id")), "part_names")
        named = joined.join(first, "component").select("fp", F.col("component").alias("part"), "component_id")
    return marked.join(materialize(named, "named"), "fp").select("doc_id", "doc", "fp", "part", "component_id")


def simhash_digest(found: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
