"""Operator 10: held-out accuracy, and the parts against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklake.llm import langid

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    return langid.train(d.filter(~langid.held_out(F.col("doc_id"))))


def test_held_out_accuracy(spark, model):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    out = langid.predict(d, model, carry=("doc_id", "lang")).filter(langid.held_out(F.col("doc_id"))).collect()
    assert len(out) > 200 and all(0 <= r.score <= 1 for r in out)
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.99


def test_codewords():
    for n in (2, 3, 4, 6, 9, 40):
        c = langid.codewords(n)
        gap = (c.shape[1] - c @ c.T) / 2 + np.eye(n) * 99
        assert c.shape[0] == n and gap.min() >= max(1, c.shape[1] // 4 - 1)
        assert (abs(c.sum(axis=0)) < n).all()
    assert langid.codewords(4).shape == (4, 7)


def test_decode_repairs_a_wrong_bit(model):
    for i, lang in enumerate(model.languages):
        for bit in range(model.codes.shape[1]):
            margins = 3 * model.codes[i].copy()
            margins[bit] *= -0.3
            assert langid.decode(model, margins)[0] == lang


def test_counts_are_those_of_the_whole_text():
    text = "Der Hund, und 12 die Katze! é" * 50
    plain = {}
    low = "".join(c if c.isalpha() else " " for c in text.lower())
    low = " " + " ".join(low.split()) + " "
    for n in (1, 2, 3):
        for i in range(len(low) - n + 1):
            plain[low[i:i + n]] = plain.get(low[i:i + n], 0) + (low[i:i + n] != " ")
    assert langid.counts(text).sum() == sum(plain.values())


def test_slices_add_up(monkeypatch):
    """Wherever a text is cut: in words, in runs of others, before a final
    sigma, at one code point."""
    texts = ["".join(chr(97 + i * i % 26) for i in range(5000)), "Der Hund, -- 12 die   Katze! é " * 60, "  12 ab", "ab  ", "a", " a ", "ΟΔΟΣ ΟΔΟΣ. " * 40,
             "x" + " " * 300 + "y", "..." * 50 + "İß ﬁ" * 30]
    whole = [langid.counts(t) for t in texts]
    for size in (1, 2, 3, 7, 100):
        monkeypatch.setattr(langid, "SLICE", size)
        for t, w in zip(texts, whole):
            assert (langid.counts(t) == w).all(), (size, t[:20])


def test_undetermined_and_odd_tables(spark, docs_of, model):
    d = docs_of([(1, None), (2, ""), (3, "12 !? 🙂"), (None, "the of and that this with"), (5, "der die und nicht"), (5, "der die und nicht")])
    d = d.withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit(0))
    rows = langid.predict(d, model).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 6 and [by[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and by[1].score == 0
    assert by[None].lang_pred == "en" and by[5].lang_pred == "de"
    empty = langid.train(docs_of([]))
    assert langid.predict(docs_of(["a"]), empty).first().lang_pred == "und"
    assert langid.predict(docs_of([]), model).count() == 0
    one = langid.train(docs_of(["abc def", "ghi"]))
    assert langid.predict(docs_of(["zzz"]), one).first().lang_pred == "en"
    long = langid.predict(docs_of(["und die " * 300_000]), model).first()
    assert long.lang_pred == "de"
