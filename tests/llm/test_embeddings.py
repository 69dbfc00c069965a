"""Operator 7 against all pairs in double precision."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklake.llm import embeddings as E
from ticklake.llm.buckets import unit_starts, whole_units

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=E.THRESHOLD):
    """{row number: (vec_id, n_links, component_id)}"""
    unit = [None if lab is None else E._unit(v) for _, v, lab in rows]
    n = len(rows)
    near = [[] for _ in rows]
    for i in range(n):
        for j in range(i + 1, n):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= threshold:
                near[i].append(j)
                near[j].append(i)
    out, seen = [None] * n, set()
    for i in range(n):
        if i in seen:
            continue
        part, todo = {i}, [i]
        while todo:
            for k in near[todo.pop()]:
                if k not in part:
                    part.add(k)
                    todo.append(k)
        seen |= part
        ids = [rows[k][0] for k in part if rows[k][0] is not None]
        for k in part:
            out[k] = (rows[k][0], len(near[k]), min(ids) if ids else None)
    return sorted(out, key=str)


def got(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit(1)).withColumn("key", F.lit("x"))
    found = E.near_vectors(df, **kw).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str)


def crowd(rng, n, spread, dim=16):
    c = rng.standard_normal(dim)
    return [(c + spread * rng.standard_normal(dim)).astype(np.float32).tolist() for _ in range(n)]


def test_equals_all_pairs(spark):
    rng = np.random.default_rng(4)
    vecs = [v for _ in range(12) for v in crowd(rng, int(rng.integers(1, 12)), 0.12)] + crowd(rng, 60, 0.1)
    rows = [(int(i * 7 % 1009), v, int(i % 2)) for i, v in enumerate(vecs)]
    rows += [(2000 + i, vecs[0], 0) for i in range(5)] + [(3000, (2 * np.array(vecs[0])).tolist(), 0)]
    rows += [(4000, None, 0), (4001, [], 0), (4002, [0.0] * 16, 0), (4003, [float("nan")] * 16, 0), (4004, [float("inf")] + [0.0] * 15, 0),
             (4005, vecs[0], None), (4006, vecs[0][:8], 0), (4007, vecs[0][:15] + [None], 0), (None, vecs[0], 0), (2000, vecs[0], 0)]
    want = brute(rows)
    assert sum(n for _, n, _ in want) > 2000
    # many tables: no pair is missed; small blocks: a crowd is many units
    assert got(spark, rows, bits=6, tables=80, block=8) == want
    assert got(spark, rows, bits=6, tables=80, block=256) == want


def test_recall_of_the_defaults():
    """Pairs at cosine 0.93 share a signature in some table."""
    rng = np.random.default_rng(5)
    a = rng.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2000, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = 0.93 * a + np.sqrt(1 - 0.93 ** 2) * b
    same = E.signatures(a, E.BITS, E.TABLES) == E.signatures(c, E.BITS, E.TABLES)
    assert same.any(axis=1).mean() > 0.97


def test_real_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in d.collect()]
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in E.near_vectors(d).collect()), key=str) == brute(rows)


def test_empty(spark):
    assert E.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    assert E.near_vectors(spark.createDataFrame([(1, None, 1)], SCHEMA)).first().component_id == 1


@pytest.mark.parametrize("rows", [1, 2, 7, 100])
def test_whole_units(rows):
    import pyarrow as pa
    keys = np.repeat(np.arange(30), np.arange(30) % 5 + 1)
    batches = [pa.RecordBatch.from_pydict({"unit": pa.array(keys[i:i + 4]), "unit2": pa.array(keys[i:i + 4])}) for i in range(0, len(keys), 4)]
    seen = list(whole_units(iter(batches), rows))
    assert [x for t in seen for x in t.column("unit").to_pylist()] == keys.tolist()
    assert sum(len(unit_starts(t)) - 1 for t in seen) == 30
