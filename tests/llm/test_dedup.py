"""Operator 2 against a plain dictionary of normalised texts."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from ticklake.llm.dedup import Bloom, exact_dedup, positions


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", t or ""), []).append(i)
    keep = {}
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep[t] = (min(known) if known else None, len(ids))
    out = []
    for i, t in rows:
        n = re.sub("[\x20\x09-\x0d]+", " ", t or "")
        out.append((i, *keep[n], hashlib.sha256(n.encode()).hexdigest()))
    return out


def check(df, rows):
    got = df.collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == sorted(brute(rows), key=str)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) and all(r.doc_id == r.keep_id for r in kept)


def test_equal_texts(docs_of):
    r = random.Random(3)
    words = ["a", "b ", "c\t", "\n", " ", "é", "\x0b", " ", "A"]
    rows = [(i, None if i % 37 == 0 else "".join(r.choice(words) for _ in range(r.randint(0, 4)))) for i in range(700)]
    rows += [(5000 + i, "x" * 100_000) for i in range(3)] + [(7, "same"), (7, "same"), (None, "same"), (None, "alone"), (None, "alone")]
    check(exact_dedup(docs_of(rows)), rows)
    # a filter far too small only sends more rows to the exact stage
    check(exact_dedup(docs_of(rows), bits=64), rows)


def test_real_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(exact_dedup(d), [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()])


def test_empty_and_clashing_names(docs_of):
    assert exact_dedup(docs_of([])).count() == 0
    d = docs_of(["a", "a", "b"])
    for c in ("keep_id", "hash", "maybe", "kept", "row", "text_sha256"):
        d = d.withColumn(c, F.lit(1))
    out = exact_dedup(d, carry=("lang", "row"))
    assert out.columns[-2:] == ["lang", "row"]
    assert sorted((r.doc_id, r.kept, r.row) for r in out.collect()) == [(0, True, 1), (1, False, 1), (2, True, 1)]


def test_filter_has_no_false_negative():
    import numpy as np
    h = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    b = Bloom(1 << 16)
    b.add(h)
    assert b.has(h).all() and positions(h, 64).max() < 64
    assert Bloom(1 << 16).has(h).sum() == 0
