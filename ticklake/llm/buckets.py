"""Units of work for buckets whose members are compared in pairs.

A bucket is cut into blocks of about ``block`` members by a hash of the
member, and every pair of blocks is a unit.  Units have at most about twice
``block`` members whatever the bucket's size, and go to tasks by their own
hash, so one bucket that holds much of the data is spread over all of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.dedup import possibly_repeated
from ticklake.session import materialize

#: A unit's key: two hashes, so that no two units are taken for one.
UNIT = ["unit", "unit2"]


def repeated_members(members: DataFrame, bucket: Sequence[str]) -> DataFrame:
    """``members`` without most of those that are alone in their bucket."""
    return possibly_repeated(members.withColumn("hash", F.xxhash64(*bucket))).filter("maybe").drop("maybe")


def units_of(members: DataFrame, bucket: Sequence[str], block: int, node: str = "node", sort_out=repeated_members,
             large: int = 0) -> DataFrame:
    """Rows of (node, bucket...) to rows of (node, bucket..., block, same,
    unit, unit2), one for each unit of the node.  Buckets of one member give
    none: ``sort_out`` leaves out most of those before any row is shuffled.
    In a unit of two blocks (``same`` is false) only pairs across the blocks
    are due.  With ``large``, a column of this name says whether the bucket
    has so many members or more."""
    members = materialize(sort_out(members, bucket), "bucket_members")
    sizes = materialize(members.groupBy(*bucket).count().filter("count > 1"), "bucket_sizes")
    blocks = F.ceil(F.col("count") / block).cast("int")
    met = members.join(sizes, list(bucket)).select(
        node, *bucket, *([(F.col("count") >= large).alias("large")] if large else []), blocks.alias("blocks"), F.pmod(F.xxhash64(node), blocks).cast("int").alias("block"))
    met = met.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    key = [*bucket, F.least("block", "other"), F.greatest("block", "other")]
    return met.select(node, *bucket, "block", *(["large"] if large else []), (F.col("block") == F.col("other")).alias("same"),
                      F.xxhash64(*key).alias("unit"), F.xxhash64(F.lit(1), *key).alias("unit2"))


def whole_units(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that hold whole units, from batches
    sorted by ``UNIT``."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        for first in range(0, b.num_rows, rows):
            held.append(b.slice(first, rows))
            if sum(x.num_rows for x in held) < rows:
                continue
            t = pa.Table.from_batches(held)
            last = unit_starts(t)[-2]
            if last:
                yield t.slice(0, last)
                held = t.slice(last).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def unit_starts(t: pa.Table) -> np.ndarray:
    """First row of each unit, and the number of rows."""
    a, b = (t.column(c).to_numpy() for c in UNIT)
    cut = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
    return np.concatenate([[0], cut, [len(a)]]).astype(np.int64)
