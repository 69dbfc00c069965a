"""Phrase mining: whole results against plain counting, blocks cut anywhere,
defined results."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ticklake.llm import phrases


def pieces_of(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, support, top=2000):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for ws in pieces_of(text):
            n[lang] += len(ws)
            for size in range(1, 6):
                for i in range(len(ws) - size + 1):
                    key = (lang, tuple(ws[i:i + size]))
                    f[key] = f.get(key, 0) + 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= support}
    covered = set()
    for (lang, ws), a in cand.items():
        for size in range(2, len(ws)):
            for i in range(len(ws) - size + 1):
                if 100 * a >= 100 * cand[lang, ws[i:i + size]]:
                    covered.add((lang, ws[i:i + size]))
    found = {}
    for (lang, ws), a in cand.items():
        if (lang, ws) in covered:
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, ws[:k]] * f[lang, ws[k:]]), k, f[lang, ws[:k]], f[lang, ws[k:]])
                             for k in range(1, len(ws)))
        found.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), l, r))
    return [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, rs in found.items()
            for i, (s, a, p, l, r) in enumerate(sorted(rs)[:top])]


def corpus(rng, n):
    vocab = ["The", "cat", "sat", "ON", "mat", "é", "日本", "a-b", "x"]
    rows = []
    for i in range(n):
        ws = rng.choice(vocab, int(rng.integers(0, 60)), p=[.3, .2, .1, .1, .1, .05, .05, .05, .05])
        seps = rng.choice([" ", "  ", "\t", ". ", ",", "\n", " "], len(ws))
        rows.append(("".join(w + s for w, s in zip(ws, seps)), ["en", "de", None, "und"][int(rng.integers(0, 4))]))
    return rows + [("the the the the the the the", "en"), (None, "en"), ("", None), (" .,;\n", "fr"), ("one", "it")]


@pytest.mark.parametrize("block", [1 << 15, 40, 7])
def test_whole_result_against_plain_counting(spark, block):
    rows = corpus(np.random.default_rng(1), 150) * 2
    rows.append((" ".join("abcab" * 300), "en"))           # one text, many blocks
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], "text string, lang string, n long, phrase string").repartition(3)
    got = sorted(map(tuple, phrases.collocations(df, support=9, top=25, block=block).collect()))
    assert got == sorted(brute(rows, 9, 25))


def test_blocks_hold_every_word_once():
    texts = ["a b. c  d\te f", "", "longword" * 5, "x," * 30, "é è à ü ö " * 9, "no gap" * 3]
    for size in (1, 3, 8, 40, 1000):
        found = []
        for data, starts, own in phrases.blocks_of(pa.array(texts), size):
            words, codes, where, limit = phrases.words_of(data, starts, own)
            mine = codes[where < limit]
            found += [words[int(c)].as_py() for c in mine]
            assert (where >= limit).sum() <= phrases.LONGEST - 1
        assert found == [w for t in texts for p in pieces_of(t) for w in p]


def test_large_numbers_are_exact(spark):
    big = spark.createDataFrame([("en", "a b", 2, 10 ** 13), ("en", "a", 1, 10 ** 13 + 7), ("en", "b", 1, 10 ** 13)],
                                "lang string, phrase string, words int, f long")
    n = spark.createDataFrame([("en", 9 * 10 ** 17)], "lang string, n long")
    row, = phrases.scored(big, n).collect()
    assert row["score"] == 1000 * 10 ** 13 * 9 * 10 ** 17 // ((10 ** 13 + 7) * 10 ** 13)


def test_ids_are_sparks(spark):
    words = ["", "a", "日本", "x" * 100]
    got = [r[0] for r in spark.createDataFrame([("fr", w) for w in words], "l string, w string").selectExpr("xxhash64(l, w)").collect()]
    assert phrases.word_ids("fr", words).tolist() == got


def test_defined_results(spark, docs_of):
    for texts in ([], [None, "", " .,"], ["one two three"]):
        assert phrases.collocations(docs_of(texts)).count() == 0
    rows = [r.asDict() for r in phrases.collocations(docs_of(["Very same row"] * 120)).collect()]
    assert rows == [{"lang": "en", "rank": 1, "phrase": "very same row", "a": 120, "l": 120, "r": 120, "n": 360, "score": 3000}]
    with pytest.raises(ValueError):
        phrases.frequent_phrases(docs_of([]), longest=6)
