"""Mixing sources: targets against exact fractions, sums against targets,
expected copies, reruns, small trees and defined results."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklake.llm import mixing


def brute_targets(size_of, weights=(5, 2, 1), share=Fraction(3, 2), most=2):
    names = sorted(size_of, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    rest, out, left = share * sum(size_of.values()), {}, set(names)
    while left:
        each = Fraction(rest) / sum(w[s] for s in left)
        full = {s for s in left if each * w[s] >= most * size_of[s]}
        if not full:
            return out | {s: each * w[s] for s in left}
        out |= {s: Fraction(most * size_of[s]) for s in full}
        rest -= sum(most * size_of[s] for s in full)
        left -= full
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(1200):
        source = "hot" if i % 3 == 0 else f"s{i % 7}" if i % 11 else None
        n = int(rng.pareto(1.2) * 20) % 3000
        rows.append((i, " ".join(["w"] * n) if i % 50 else None, source, "x", "y", i))
    rows += [(7, "a b c", "é", "x", "y", 1)] * 40 + [(None, "a  b\tc\n d", "Z", "x", "y", 1)] * 37
    rows += [(2 ** 60 + i, "one two", "big", "x", "y", 1) for i in range(9)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, target string, size string, copy long").repartition(5)


def taken_by_source(docs, out):
    rows = out.collect()
    assert len(rows) == docs.count()
    return rows


def test_targets_and_sums(corpus):
    sizes = {r["source"]: r["n"] for r in corpus.groupBy("source").agg(F.sum(mixing.words(F.col("text"))).alias("n")).collect()}
    want = brute_targets(sizes)
    got = mixing.mix_sources(corpus, fan=16)
    by = {}
    for r in taken_by_source(corpus, got):
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        rate = r["target"] / r["source_size"] if r["source_size"] else 0.0
        assert np.floor(rate) <= r["copies"] <= np.ceil(rate)
        key = (r["source_size"], round(r["target"], 6))
        total, longest = by.get(key, (0, 0))
        by[key] = (total + r["taken"], max(longest, r["size"]))
    assert sorted(by) == sorted({(sizes[s], round(float(t), 6)) for s, t in want.items()})
    assert sum(want.values()) == Fraction(3, 2) * sum(sizes.values())
    for (_, target), (total, longest) in by.items():
        assert abs(total - target) <= longest / 2 + 1e-6


def test_reruns_agree_whatever_the_partitions(corpus):
    a = mixing.mix_sources(corpus, fan=32).collect()
    b = mixing.mix_sources(corpus.repartition(3), fan=32).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))
    assert sorted(map(str, a)) != sorted(map(str, mixing.mix_sources(corpus, fan=32, seed=12).collect()))


def test_settle_keeps_words_and_expectations():
    size = np.array([900, 400, 100, 77, 60, 13, 5, 5, 2, 1])
    share = np.array([.3, .9, .5, .25, .6, .1, .8, .4, .5, .7])
    total, n = np.zeros(len(size)), 20_000
    for seed in range(n):
        out = mixing.settle(size, share, np.random.default_rng(seed))
        assert ((out > 0) & (out < 1)).sum() <= 1
        assert out @ size == pytest.approx(share @ size)
        total += out
    assert np.abs(total / n - share).max() < 0.02


def test_defined_results(spark, docs_of):
    empty = docs_of([]).select("doc_id", "text", "source")
    assert mixing.mix_sources(empty).count() == 0
    silent = mixing.mix_sources(docs_of([None, "", " \t\n"])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in silent] == [(0, 0.0, 0)] * 3
    one = mixing.mix_sources(docs_of([(2 ** 60 + 1, "x " * 100_000)])).collect()
    assert [(r["doc_id"], r["size"], r["target"], r["taken"]) for r in one] == [(2 ** 60 + 1, 100_000, 150_000.0, 200_000)]
