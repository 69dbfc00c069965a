"""Operator 5 against all pairs, and the pigeonring chains by themselves."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ticklake.llm.components import connected_components
from ticklake.llm.hamming import bit_sums, near_links
from ticklake.llm.simhash import fingerprint, near_duplicates, pigeonring, simhash_digest


def brute_fp(text, k=3):
    import re
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", low)
    if not w:
        return 0
    s = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_parts(nodes, near):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if near(a, b):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {n: root(n) for n in nodes}


def brute(rows, k=3, d=2):
    fps = {}
    for i, t in rows:
        fps.setdefault(brute_fp(t, k), []).append(i)
    part = brute_parts(list(fps), lambda a, b: (a ^ b).bit_count() <= d)
    least = {}
    for f, ids in fps.items():
        known = [i for i in ids if i is not None]
        if known:
            least[part[f]] = min(least.get(part[f], known[0]), *known)
    return sorted(((i, f"{brute_fp(t, k):016x}", least.get(part[brute_fp(t, k)])) for i, t in rows), key=str)


def got(df, **kw):
    return sorted((tuple(r) for r in simhash_digest(near_duplicates(df, **kw)).collect()), key=str)


EDGE = [None, "", " \n\t", "One", "one two", "one two three", "ONE two\x0bthree four", "É é", "a b", "x " * 70_000]


def test_equals_all_pairs(docs_of):
    r = random.Random(1)
    rows = [(i, t) for i, t in enumerate(EDGE)]
    for g in range(40):
        base = [r.choice("abcdefghijklmnop") * r.randint(1, 5) for _ in range(r.randint(3, 300))]
        for _ in range(r.randint(1, 6)):
            w = list(base)
            for _ in range(r.randint(0, 2)):
                w[r.randrange(len(w))] = "new"
            rows.append((len(rows) * 7 % 1009, " ".join(w)))
    rows += [(None, "one two"), (3, "one"), (3, "one")]
    d = docs_of(rows).withColumn("fp", F.lit("x")).withColumn("component", F.lit(1))
    assert got(d) == brute(rows)
    assert got(d, distance=3) == brute(rows, d=3)
    assert got(d, distance=0, shingle=2) == brute(rows, k=2, d=0)


def test_real_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert got(d) == brute([tuple(r) for r in d.collect()])


def test_empty(docs_of):
    assert got(docs_of([])) == []


def test_words_split_as_given():
    for t in EDGE + ["a b c d e", "a\x1cb c d", "ÀÉ X Y z"]:
        assert fingerprint(t) == brute_fp(t)


@pytest.mark.parametrize("d", [1, 2, 3])
def test_every_near_pair_meets_under_some_mask(d):
    """At each level, a pair within ``d`` bits shares a mask of a chain that
    keeps it; a chain that keeps a pair never exceeds ``d``."""
    rng, method = np.random.default_rng(d), pigeonring(d)
    for _ in range(120):
        x = 0
        for b in rng.choice(64, int(rng.integers(0, d + 1)), replace=False):
            x |= 1 << int(b)
        chains = [c for c in range(len(method.masks[0])) if method.check(np.array([x], np.uint64), c)[0]]
        assert chains
        for level in method.masks:
            assert any(x & m == 0 for c in chains for m in level[c])
    far = np.array([(1 << (d + 1)) - 1, 0xFFFF0000FFFF], np.uint64)
    assert not any(method.check(far, c).any() for c in range(len(method.masks[0])))


def test_large_buckets_are_dealt_out_again(spark):
    """A crowd of fingerprints around one: far more than a bucket holds."""
    rng = np.random.default_rng(3)
    fps = {0}
    while len(fps) < 400:
        x = 0x123456789ABCDEF
        for b in rng.choice(64, int(rng.integers(0, 4)), replace=False):
            x ^= 1 << int(b)
        fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    want = brute_parts(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    sizes = sorted(list(want.values()).count(v) for v in set(want.values()) if list(want.values()).count(v) > 1)
    for full in (8, 64, 1000):
        links = near_links(df, pigeonring(2), full=full)
        parts = {r.node % 2**64: r.component for r in connected_components(links).collect()}
        assert sorted(list(parts.values()).count(v) for v in set(parts.values())) == sizes


def test_bit_sums():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 1 << 63, (3000, 2)).astype(np.uint64) * np.uint64(3)
    starts = np.array([0, 1, 5, 260, 515, 770, 2999])
    want = np.add.reduceat(np.unpackbits(h.view(np.uint8), axis=1, bitorder="little").astype(np.int64), starts, axis=0)
    assert (bit_sums(h, starts) == want).all()


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 500), (700, 701), (701, 700), (None, 3)]
    random.Random(2).shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {700: 700, 701: 700}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
