"""Exact ordered-sequence operators that do not funnel a key into one task.

A plain ``Window.partitionBy(key).orderBy(t)`` puts every row of a key in
one task; with a handful of instruments (or one log partition, or one
group of duplicates holding a third of the data) that task is the job.
These operators cut each key into *slices* -- contiguous ranges of the
order (a time bucket, a sequence bucket) -- run the window per
(key, slice) and carry the state that crosses a slice boundary through a
small per-slice summary:

* ``ordered_position``: row position inside the key (counts of earlier
  slices + local row number).
* ``lag_across_slices``: previous row's value (last value of the
  previous non-empty slice for a slice's first row).
* ``running_max_across_slices``: running maximum (max of earlier slices
  combined with the local running max).
* ``rolling_previous``: aggregates over the previous ``k`` rows.  Rows
  with more than ``k`` predecessors in their own slice are finished by the
  local window; the at most ``2k`` boundary rows per slice are re-windowed
  in row-count blocks with a ``k``-row overlap, which is exact for gaps of
  any length.

The summary has one row per (key, slice); its window runs per key over
those few columns only.  The join back is against data that is already
hash-partitioned on (key, slice), so only the summary moves (AQE turns it
into a broadcast when its measured size is small).  Keys are wrapped in a
struct so that null keys form their own group, as in a plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_K = "__seq_key"      # struct(keys)
_G = "__seq_grp"      # struct(struct(keys), slice)
_S = "__seq_slice"


def _prepare(df: DataFrame, keys: Sequence[str], slice_expr: Column) -> DataFrame:
    k = F.struct(*[F.col(c) for c in keys]) if keys else F.struct(F.lit(0).alias("_"))
    d = df.select("*", k.alias(_K), slice_expr.alias(_S))
    return d.select("*", F.struct(F.col(_K), F.col(_S)).alias(_G))


def _summary_window() -> WindowSpec:
    return Window.partitionBy(_K).orderBy(_S)


def _finish(df: DataFrame) -> DataFrame:
    return df.drop(_K, _S, _G)


def ordered_position(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                     slice_expr: Column, name: str = "pos") -> DataFrame:
    """Adds ``name``: the 0-based position of the row inside its key in
    ``order``.  ``slice_expr`` must be non-decreasing along ``order``."""
    d = _prepare(df, keys, slice_expr)
    counts = d.groupBy(_G).agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.select(_G, F.col(f"{_G}.{_K}").alias(_K), F.col(f"{_G}.{_S}").alias(_S), "__n")
    offs = counts.select(
        _G, F.coalesce(F.sum("__n").over(_summary_window().rowsBetween(Window.unboundedPreceding, -1)),
                       F.lit(0)).alias("__off"))
    local = d.withColumn("__rn", F.row_number().over(Window.partitionBy(_G).orderBy(*order)))
    out = local.join(offs, _G, "left")
    return _finish(out.withColumn(name, F.col("__off") + F.col("__rn") - 1).drop("__off", "__rn"))


def lag_across_slices(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                      order_key: Column | None, slice_expr: Column, value: str,
                      name: str) -> DataFrame:
    """Adds ``name`` = ``value`` of the previous row of the key in ``order``.

    ``order_key`` is one orderable column equivalent to ``order``; the
    last value of a slice is ``max_by(value, order_key)``.  Pass None when
    ``value`` itself never decreases along ``order`` (e.g. the timestamp
    that leads the order): the summary is then a plain ``max``.
    """
    d = _prepare(df, keys, slice_expr)
    wl = Window.partitionBy(_G).orderBy(*order)
    local = (d.withColumn("__lag", F.lag(value).over(wl))
              .withColumn("__first", F.row_number().over(wl) == 1))
    last_val = F.max(value) if order_key is None else F.max_by(F.col(value), order_key)
    last = d.groupBy(_G).agg(last_val.alias("__last"))
    last = last.select(_G, F.col(f"{_G}.{_K}").alias(_K), F.col(f"{_G}.{_S}").alias(_S), "__last")
    prev = last.select(_G, F.lag("__last").over(_summary_window()).alias("__prev"))
    out = local.join(prev, _G, "left")
    out = out.withColumn(name, F.when(F.col("__first"), F.col("__prev")).otherwise(F.col("__lag")))
    return _finish(out.drop("__lag", "__first", "__prev"))


def running_max_across_slices(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                              slice_expr: Column, value: str, name: str) -> DataFrame:
    """Adds ``name`` = max of ``value`` over all rows of the key up to and
    including this one in ``order``."""
    d = _prepare(df, keys, slice_expr)
    wl = Window.partitionBy(_G).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = d.withColumn("__lmax", F.max(value).over(wl))
    smax = d.groupBy(_G).agg(F.max(value).alias("__smax"))
    smax = smax.select(_G, F.col(f"{_G}.{_K}").alias(_K), F.col(f"{_G}.{_S}").alias(_S), "__smax")
    prior = smax.select(_G, F.max("__smax").over(
        _summary_window().rowsBetween(Window.unboundedPreceding, -1)).alias("__prior"))
    out = local.join(prior, _G, "left")
    out = out.withColumn(name, F.greatest(F.col("__lmax"), F.col("__prior")))
    return _finish(out.drop("__lmax", "__prior"))


AggFn = Callable[[WindowSpec], Column]

SLICE_TARGET_ROWS = 1 << 20
SAMPLE_PER_SLICE = 64


def row_slices(df: DataFrame, keys: Sequence[str], order: str, row_id: Sequence[str],
               target_rows: int = SLICE_TARGET_ROWS) -> DataFrame:
    """Start values of the slices of every key, as rows of (keys...,
    ``bounds``: sorted array), such that a slice holds about ``target_rows``
    rows however unevenly they lie on the order column.

    One statistics pass: rows whose id hashes under the sampling share (the
    same rows on every evaluation) are ranked per key, and every
    ``SAMPLE_PER_SLICE``-th starts a slice; a slice's size then varies by
    about 1 / sqrt(SAMPLE_PER_SLICE).  Rows of one order value stay
    together.  Compute it once per dataset (``materialize``) and pass it to
    ``slice_by_bounds``: operators run no statistics job of their own."""
    share = min(1.0, SAMPLE_PER_SLICE / target_rows)
    step = max(1, round(target_rows * share))
    top = -2.0 ** 63 + 2.0 ** 64 * share
    s = df.filter(F.xxhash64(*row_id).cast("double") <= F.lit(top)).select(*keys, F.col(order).alias("__o"))
    k = F.struct(*keys).alias(_K)
    s = s.select(k, "__o").withColumn("__rn", F.row_number().over(Window.partitionBy(_K).orderBy("__o")))
    b = s.filter(F.col("__rn") % step == 0).groupBy(_K).agg(F.array_sort(F.collect_set("__o")).alias("bounds"))
    return b.select(f"{_K}.*", "bounds")


#: Items of a KLL sketch's lowest level: its rank error is about 0.04%.
SKETCH_K = 1 << 14
#: Quantiles that are read from a sketch, in groups that a row searches one after the other.
SKETCH_GRID, SKETCH_GROUP = 1024, 32


def sketch_slices(df: DataFrame, keys: Sequence[str], bucket: Column, order: Column,
                  target_rows: int = SLICE_TARGET_ROWS) -> DataFrame:
    """Start values of slices of about ``target_rows`` rows, as rows of
    (keys..., ``bucket``, ``bounds``): a KLL sketch of ``order`` (a long) per
    key and bucket (a coarse range of the order).

    Sketches merge, so a hot key and bucket is one sketch a task before
    anything is shuffled.  Buckets of at most ``target_rows`` rows are whole
    and have no row here: the table has at most one row per ``target_rows``
    rows of data.  ``bounds`` are in groups of ``SKETCH_GROUP``.  Up to half of
    ``SKETCH_GRID`` slices of a key and bucket stay within twice the target; a
    larger one is cut into ``SKETCH_GRID`` slices.  Rows of one order value
    stay together."""
    g = df.groupBy(*keys, bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("__n"), F.kll_sketch_agg_bigint(order, F.lit(SKETCH_K)).alias("__s"))
    ranks = F.array(*[F.lit(i / SKETCH_GRID) for i in range(1, SKETCH_GRID)])
    g = g.filter(F.col("__n") > target_rows).withColumn("__q", F.kll_sketch_get_quantile_bigint("__s", ranks))
    cuts = F.least(F.ceil(F.col("__n") / target_rows), F.lit(SKETCH_GRID)).cast("int")
    at = F.transform(F.sequence(F.lit(1), cuts - 1), lambda j: F.get(F.col("__q"), F.round(j * SKETCH_GRID / cuts).cast("int") - 1))
    g = g.withColumn("__b", F.array_distinct(at))
    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size("__b") - 1) / SKETCH_GROUP).cast("int")),
                         lambda i: F.slice("__b", i * SKETCH_GROUP + 1, F.lit(SKETCH_GROUP)))
    return g.select(*keys, "bucket", groups.alias("bounds"))


def slice_by_sketch(df: DataFrame, keys: Sequence[str], bucket: Column, start: Column, order: Column,
                    bounds: DataFrame, name: str) -> DataFrame:
    """Adds ``name``: the start of the row's slice (the largest of the key and
    bucket's ``bounds`` that is not above ``order``; before the first one, and
    where there are none, ``start``, the bucket's own)."""
    b = bounds.select(F.struct(*keys, "bucket").alias("__bk"), F.col("bounds").alias("__b"))
    d = df.withColumn("__o", order).join(b, F.struct(*keys, bucket.alias("bucket")).eqNullSafe(F.col("__bk")), "left")
    group = F.try_element_at(F.filter("__b", lambda g: F.get(g, 0) <= F.col("__o")), F.lit(-1))
    bound = F.try_element_at(F.filter(group, lambda x: x <= F.col("__o")), F.lit(-1))
    return d.withColumn(name, F.coalesce(bound, start)).drop("__bk", "__b", "__o")


def slice_by_bounds(df: DataFrame, keys: Sequence[str], order: str, bounds: DataFrame, name: str = "__slice") -> DataFrame:
    """Adds ``name``: how many of the key's ``bounds`` are not above the
    row's order value (non-decreasing along the order; 0 without bounds)."""
    b = bounds.select(F.struct(*keys).alias("__bk"), F.col("bounds").alias("__b"))
    d = df.join(b, F.struct(*keys).eqNullSafe(F.col("__bk")), "left")
    n = F.coalesce(F.size(F.filter("__b", lambda x: x <= F.col(order))), F.lit(0))
    return d.withColumn(name, n).drop("__bk", "__b")


def rolling_previous(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                     slice_expr: Column, k: int, aggs: dict[str, AggFn],
                     block_rows: int = 1 << 20) -> DataFrame:
    """Adds one column per ``aggs`` entry, each computed by ``fn(spec)``
    where ``spec`` is an ordered window over the key; ``fn`` must only look
    at the previous ``k`` rows (e.g. ``F.avg(x).over(spec.rowsBetween(-k, -1))``).
    """
    from ticklake.session import materialize
    if block_rows <= k:
        raise ValueError("block_rows must exceed k")
    d = _prepare(df, keys, slice_expr)
    wl = Window.partitionBy(_G).orderBy(*order)
    local = d.withColumn("__rn", F.row_number().over(wl))
    # null: fewer than k rows of the slice follow
    local = local.withColumn("__tail", F.lead(F.lit(1), k).over(wl).isNull())
    for c, fn in aggs.items():
        local = local.withColumn(c, fn(wl))
    cols = df.columns + list(aggs)
    # written once: the source is scanned and shuffled once, and interior
    # rows, boundary rows and the slice counts all read this table
    local = materialize(local, "rolling_local")
    counts = local.groupBy(_G).agg(F.max("__rn").alias("__n"))
    counts = counts.select(_G, F.col(f"{_G}.{_K}").alias(_K), F.col(f"{_G}.{_S}").alias(_S), "__n")
    offs = counts.select(
        _G, F.coalesce(F.sum("__n").over(_summary_window().rowsBetween(Window.unboundedPreceding, -1)),
                       F.lit(0)).alias("__off"))

    interior = local.filter(F.col("__rn") > k).select(*cols)

    # Boundary rows: the first k and the last k of every slice (filtered
    # before the join, so only they meet the summary).  Any row within k
    # positions before a first-k row is itself a boundary row, so windows
    # over the boundary set alone see the true predecessors.
    b = local.filter((F.col("__rn") <= k) | F.col("__tail")).drop(*aggs, "__tail")
    b = b.join(offs, _G, "left")
    pos = F.col("__off") + F.col("__rn") - 1
    blk = F.floor(pos / F.lit(block_rows))
    # a row among the last k of a block is copied into the next block
    tail = (pos % F.lit(block_rows)) >= F.lit(block_rows - k)
    b = (b.withColumn("__pos", pos)
          .withColumn("__copy", F.explode(F.when(tail, F.array(F.lit(False), F.lit(True)))
                                          .otherwise(F.array(F.lit(False)))))
          .withColumn("__blk", blk + F.col("__copy").cast("long")))
    wb = Window.partitionBy(_K, "__blk").orderBy("__pos")
    for c, fn in aggs.items():
        b = b.withColumn(c, fn(wb))
    heads = b.filter(~F.col("__copy") & (F.col("__rn") <= k)).select(*cols)
    return interior.unionByName(heads)


def hot_keys(df: DataFrame, keys: Sequence[str], row_id: Sequence[str], fraction: float, min_sampled: int) -> DataFrame:
    """All keys with at least ``min_sampled`` rows among those whose id
    hashes under ``fraction``: the same rows, and so the same keys, on every
    evaluation.  A key needs about ``min_sampled / fraction`` rows to be
    found, which bounds their number by the table's rows over that."""
    top = -2.0 ** 63 + 2.0 ** 64 * min(1.0, fraction)
    s = df.filter(F.xxhash64(*row_id).cast("double") <= F.lit(top))
    k = F.struct(*[F.col(c) for c in keys])
    return (s.groupBy(k.alias(_K)).agg(F.count(F.lit(1)).alias("__c"))
             .filter(F.col("__c") >= min_sampled).select(_K, F.lit(True).alias("__hot")))


def ordered_position_hot(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                         slice_expr: Column, row_id: Sequence[str], name: str = "pos",
                         fraction: float = 0.001, min_sampled: int = 500) -> DataFrame:
    """``ordered_position`` for many keys of which a few may be huge (e.g.
    duplicate groups).

    Only keys found hot in a sample are cut into slices; every other key
    is one window partition with offset 0, so the common case costs one
    shuffle of the rows -- the same as a plain window.  The hot set is
    computed once and written (``materialize``), so both branches that read
    it see the same keys whatever the optimizer does; hot keys' slice
    counts come from a partial aggregate over the hot rows only.  Joins are
    left to AQE, which broadcasts by measured size.
    """
    from ticklake.session import materialize
    hot = materialize(hot_keys(df, keys, row_id, fraction, min_sampled), "hot_keys")
    k = F.struct(*[F.col(c) for c in keys]) if keys else F.struct(F.lit(0).alias("_"))
    d = (df.withColumn(_K, k)
           .join(hot, _K, "left")
           .withColumn(_S, F.when(F.col("__hot"), slice_expr))
           .withColumn(_G, F.struct(F.col(_K), F.col(_S))))
    counts = d.filter(F.col("__hot")).groupBy(_G).agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.select(_G, F.col(f"{_G}.{_K}").alias(_K), F.col(f"{_G}.{_S}").alias(_S), "__n")
    offs = counts.select(
        _G, F.coalesce(F.sum("__n").over(_summary_window().rowsBetween(Window.unboundedPreceding, -1)),
                       F.lit(0)).alias("__off"))
    local = d.withColumn("__rn", F.row_number().over(Window.partitionBy(_G).orderBy(*order)))
    out = local.join(offs, _G, "left")
    pos = F.coalesce(F.col("__off"), F.lit(0)) + F.col("__rn") - 1
    return _finish(out.withColumn(name, pos.cast("long")).drop("__off", "__rn", "__hot"))
