"""Operator 11: mixing sources to target weights by pivotal dependent rounding.

Every source has a target number of words: a share by its weight, at most
``most`` times its size, what is above reshared among the others.  A
document's copy number is its source's target over the source's size: a whole
part, taken as it is, and a fraction.  Fractions are settled in pairs: of two
documents of a source, words move from one to the other, in a direction drawn
so that both keep their expected copies, until one of them is whole.  The sum
of the words of a pair never changes, so a source ends with its target but
for one document, which goes to its nearer whole number.

Pairs are settled in a tree.  A node of ``fan`` documents or fewer is settled
in one task, longest documents first, and leaves at most one fraction, which
moves to a node of the next level; a source of n documents needs
log(n) / log(fan) levels, each written to the shared checkpoint folder.
A document's place in the tree and every draw follow from hashes of its id,
size and source, so reruns agree whatever the partitions.

Scale: texts are read once, to be counted.  Rows equal in id, source and size
are first counted, so that copies of one row do not meet in one node; the
targets meet the rows by (source, salt), so no source is one task.

Defined results: null text has no words; a null source is a source, the last;
a source without words has target zero and gives nothing; null and repeated
ids are documents like any other; an empty table gives an empty result; the
input's other columns play no part, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticklake.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
FAN = 4096
SALTS = 32


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``nth`` (from 0) by ``order``: the rows are range-partitioned, each
    partition numbers its own, and a row a partition carries the counts."""
    d = materialize(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    counts = d.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    local = d.withColumn("rn", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    out = local.join(counts.select("part", before.alias("before")), "part")
    return out.withColumn("nth", F.col("before") + F.col("rn") - 1).drop("part", "rn", "before")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sizes`` (source, docs, source_size) with ``source_id`` (its place by
    code point, null last), ``weight`` and ``target``.

    Sources that stop at ``most`` times their size are found round by round:
    each round's two sums are all that the driver sees."""
    s = numbered(sizes.withColumn("none", F.col("source").isNull()), ["none", "source"])
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("nth") % len(weights)).cast("int"))
    s = materialize(s.select("source", "docs", "source_size", F.col("nth").alias("source_id"), weight.alias("weight"),
                             (F.col("source_size") * F.lit(float(most))).alias("cap")), "sources")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1                     # words per unit of weight; sources at their cap
    while True:
        at_cap = F.col("cap") <= F.lit(level) * F.col("weight")
        r = s.agg(F.count_if(at_cap).alias("full"), F.sum(F.when(at_cap, F.col("cap"))).alias("gone"),
                  F.sum(F.when(~at_cap, F.col("weight"))).alias("left")).first()
        if r["full"] == full or not r["left"]:
            break
        full, level = r["full"], max(level, (total * share - (r["gone"] or 0.0)) / r["left"])
    return s.withColumn("target", F.least("cap", F.lit(level) * F.col("weight"))).drop("cap")


def settle(size: np.ndarray, share: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Copies (0 or 1) of documents of ``size`` words of which ``share`` are
    to be taken, in order; at most one is left as a fraction."""
    out = share.astype(np.float64)
    held = -1                                  # the document that is a fraction
    draws = rng.random(len(size))
    for i in range(len(size)):
        if not 0.0 < out[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b = float(size[held]), float(size[i])
        u, v = out[held] * a, out[i] * b       # words taken of both
        up, down = min(a - u, v), min(u, b - v)
        if draws[i] * (up + down) < down:      # words move from the new one to the held one
            held_done, new_done = a - u <= v, v <= a - u
            out[held], out[i] = (1.0 if held_done else (u + up) / a), (0.0 if new_done else (v - up) / b)
        else:
            held_done, new_done = u <= b - v, b - v <= u
            out[held], out[i] = (0.0 if held_done else (u - down) / a), (1.0 if new_done else (v + down) / b)
        # rounding may bring a fraction to its end as well
        held_done, new_done = held_done or not 0.0 < out[held] < 1.0, new_done or not 0.0 < out[i] < 1.0
        held = -1 if held_done and new_done else i if held_done else held
    return out


def _level(seed: int, level: int):
    """Settles one node.  Arrow, so that ids keep their type."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        col = {c: rows[c].to_numpy() for c in ("size", "place", "copy", "share")}
        order = np.lexsort((col["copy"], col["place"], -col["size"]))
        rng = np.random.default_rng([seed, level, key[0].as_py(), key[1].as_py()])
        share = np.empty(len(order))
        share[order] = settle(col["size"][order], col["share"][order], rng)
        return rows.set_column(rows.column_names.index("share"), "share", pa.array(share))
    return run


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, fan: int = FAN,
                seed: int = 11) -> DataFrame:
    """A row a document: ``doc_id``, ``size``, ``source_size``, ``target``,
    ``copies`` (how often the mix takes it) and ``taken`` (words)."""
    sized = materialize(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                                    words(F.col(f"`{text_col}`")).alias("size")), "sized")
    goal = targets(sized.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size")),
                   weights, share, most)
    goal = materialize(goal.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "targets")
    same = sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    same = same.withColumn("salt", F.pmod(F.xxhash64("doc_id", "size"), F.lit(SALTS)).cast("int"))
    goal = goal.withColumnRenamed("source", "of")
    met = same.join(goal, F.col("source").eqNullSafe(F.col("of")) & (same["salt"] == goal["salt"])).drop("of", "salt")
    met = met.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    place = F.xxhash64(F.lit(seed), "doc_id", "size", "source_id", "copy")
    now = met.select("source_id", "docs", "source_size", "target", "doc_id", "size", "copy", F.floor(rate).alias("base"),
                     (rate - F.floor(rate)).alias("share"), place.alias("place"))
    # a place in the tree: the documents of a source, dealt into nodes of about `fan`
    nodes = F.ceil(F.col("docs") / fan)
    now = now.withColumn("node", F.pmod("place", nodes))
    whole = (F.col("size") == 0) | (F.col("share") == 0.0)
    done = [now.filter(whole).withColumn("share", F.lit(0.0))]
    now = now.filter(~whole)
    most_docs = goal.agg(F.max("docs")).first()[0] or 0
    cols, level, width = now.columns, 0, max(1, -(-most_docs // fan))
    schema = now.schema
    while True:
        step = materialize(now.groupBy("source_id", "node").applyInArrow(_level(seed, level), schema), f"mix_{level}")
        fraction = (F.col("share") > 0.0) & (F.col("share") < 1.0)
        done.append(step.filter(~fraction))
        now = step.filter(fraction)
        if width <= 1:
            # one fraction a source at most: its nearer whole number
            done.append(now.withColumn("share", F.round("share")))
            break
        level, width = level + 1, -(-width // fan)
        now = now.withColumn("node", F.floor(F.col("node") / fan).cast("long"))
    out = done[0].select(*cols)
    for d in done[1:]:
        out = out.unionByName(d.select(*cols))
    copies = (F.col("base") + F.col("share")).cast("long")
    return out.select("doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
