"""Operator 4: held-out texts, planted lines and odd tables."""

import pytest
from pyspark.sql import functions as F

from ticklake.llm import licenses as L

SF = "/root/testdata/sf0.01"
# what the driver's licence lines name, by a plain search of the text
PLAIN = {"CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
         "Apache-2.0": "Licensed under the Apache License, Version 2.0.", "MIT": "Released under the MIT License."}


@pytest.fixture(scope="module")
def found(spark):
    return L.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_finds_the_planted_lines_and_nothing_else(spark, found):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r.doc_id: ",".join(sorted(k for k, line in PLAIN.items() if line in (r.text or "").split("\n"))) for r in d.collect()}
    got = {r.doc_id: r.licences for r in L.licences(d, found).collect()}
    assert got == want and sum(bool(v) for v in want.values()) > 10


def test_wordings_not_in_the_templates(docs_of, found):
    texts = ["licensed under the apache license version 2.0, see below", "Code is RELEASED UNDER THE MIT LICENSE!",
             "Redistribution and use in source and binary forms, with or without changes and modification, are permitted provided that the following conditions are met",
             "word " * 300 + "Licensed under the Apache License, Version 2.0 " + "word " * 300,
             "The cat sat on the mat and looked at the dog for a while", "licence", ""]
    got = [r.licences for r in L.licences(docs_of(texts), found).orderBy("doc_id").collect()]
    assert got[:2] == ["Apache-2.0", "MIT"] and "BSD" in got[2] and got[3] == "Apache-2.0" and got[4:] == ["", "", ""]


def test_unknown_licence(docs_of, found):
    got = L.find_licences(docs_of(["Licensed under the terms of our own software license agreement, version 9"]), found).collect()
    assert [r.family for r in got] == ["unknown"]


def test_odd_tables(spark, docs_of, found):
    assert L.licences(docs_of([]), found).count() == 0
    d = docs_of([(None, None), (1, "Released under the MIT License."), (1, "x"), (None, "a b c d")])
    for c in ("words", "features", "p", "paragraph", "score"):
        d = d.withColumn(c, F.lit("x"))
    got = sorted(((r.doc_id, r.licences) for r in L.licences(d, found).collect()), key=str)
    assert got == [(1, "MIT"), (1, "MIT"), (None, ""), (None, "")]
    assert L.train(docs_of([])).threshold == 0.5


def test_windows_cover_all_words(docs_of):
    for n in (3, 63, 64, 65, 96, 97, 200):
        rows = L.windows(docs_of([" ".join(f"w{i}" for i in range(n))]).select("doc_id", "text")).collect()
        assert {w for r in rows for w in r.words} == {f"w{i}" for i in range(n)}
        assert all(r.words[0] == f"w{r.window}" for r in rows)


def test_wrapped_licences_and_titles(docs_of, found):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation "
           "files (the \"Software\"), to deal\nin the Software without restriction")
    gpl = ("it under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n"
           "(at your option) any later version")
    texts = [f"Some words of the day\n\n{mit}\n\nand others", gpl, "Words here\nMIT License\nother words", "Apache-2.0",
             "Released under the MIT License.\nLicensed under the Apache License, Version 2.0\n"
             "All rights reserved. Unauthorized copying of this file is strictly prohibited"]
    got = [r.licences for r in L.licences(docs_of(texts), found).orderBy("doc_id").collect()]
    assert "MIT" in got[0].split(",") and "GPL-3.0" in got[1].split(",") and got[2:] == ["MIT", "Apache-2.0", "Apache-2.0,MIT,unknown"]


def test_words_and_threshold_come_from_all_windows(docs_of):
    """Words rare in the sample but common in the table are not telling;
    licence talk of no known family does not make its words common."""
    plain = [f"the {i} rivers and {i * 7} hills were seen by us" for i in range(300)]
    talk = [t for t in L.OTHER_LICENCES for _ in range(8)]
    common = [f"a mozilla was seen {i} times near the lake" for i in range(40)]
    d = docs_of(plain + talk + common)
    c = L.train(d, sample_docs=400, sample_windows=3)
    assert "mozilla" not in c.telling and {"proprietary", "unauthorized", "vendor"} <= set(c.telling)
    assert c.threshold <= 0.99 and L.licences(d, c).filter("licences = 'unknown'").count() >= len(talk) * 0.8


def test_counts_less_licences_are_counts_of_ordinary_windows(docs_of):
    known = [t for group in L.TEMPLATES.values() for t in group]
    half = [" ".join(w[:len(w) // 2 + 2]) for w in map(L.plain_words, known + list(L.OTHER_LICENCES))]
    d = docs_of(known + half + list(L.ORDINARY) * 5).select("doc_id", "text")
    ordinary = L._ordinary(L.windows(d)).select("words").collect()
    words, n = L.telling_words(d)
    assert n == len(ordinary) and len(ordinary) < d.count()
    assert all(sum(w in r.words for r in ordinary) <= L.COMMON * n for w in words) and "copy" not in words and "gnu" in words
