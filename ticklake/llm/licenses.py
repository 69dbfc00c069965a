"""Operator 4: licence scans by a trained paragraph classifier.

A paragraph ends at a blank line.  Each of its lines is read, and all of them
joined, as licences may be wrapped; more than ``WINDOW`` words are read in
windows that overlap by half.  Features are sparse counts of words and
word pairs: those of the fixed licence texts that hold a *telling* word, one
that few ordinary paragraphs have.  A multinomial logistic regression over
them knows the classes *none*, *unknown* (speaks of a licence, but of no
known one) and the families.  The score from which a paragraph counts as a
licence is calibrated on ordinary paragraphs that training has not seen, and
lies above the score of a paragraph without any feature (words are counted and
scores calibrated over all windows but those like a fixed licence text); so paragraphs
without a telling word are *none* and never reach the model.  A predicted
family is confirmed by comparing the paragraph with the family's templates:
the share of a template's word triples that it holds.  Unconfirmed ones are
*unknown*.

Everything runs in the JVM (DataFrame functions and Spark ML).  Scanning is
a narrow map over whole texts; only findings are shuffled.  The model is fitted
on a bounded sample: about ``SAMPLE_DOCS`` documents and at most
``SAMPLE_WINDOWS`` of their windows, both by hash, as ordinary text, and the
fixed templates.

Defined results: null and empty texts hold no licence; every input row gives
one row, rows that share an id share its findings; null ids are one id; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticklake.session import materialize

WINDOW = 64
COMMON = 0.01
SAMPLE_DOCS = 1500
SAMPLE_WINDOWS = 8000
CONFIRM = 0.8
FALSE_ALARMS = 0.001
NONE, UNKNOWN = "none", "unknown"

# How well-known licences name themselves.
TEMPLATES = {
    "MIT": (
        "MIT License",
        "Released under the MIT License",
        "Licensed under the MIT License",
        "This project is licensed under the terms of the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache-2.0": (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0",
        "Released under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License v3",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License",
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "AGPL-3.0": (
        "Licensed under the GNU Affero General Public License, version 3",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "BSD": (
        "BSD License",
        "Released under the BSD License",
        "Licensed under the 3-Clause BSD License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License, Version 2.0",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "CC0-1.0": (
        "Released under CC0 1.0 Universal, Public Domain Dedication",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    ),
}
# Licence talk of no known family, and ordinary uses of the words.
OTHER_LICENCES = (
    "All rights reserved. Unauthorized copying of this file is strictly prohibited",
    "Licensed under the terms of our own software license agreement",
    "This work may be used under the publisher's custom license, version 1",
    "Use of this material is governed by the accompanying end user license agreement",
    "Released under a proprietary license of the vendor",
)
ORDINARY = (
    "The driver showed a valid license and the car was released",
    "The film was released under a new title and with permission of the studio",
    "The general public is free to use the source of the river",
    "Her work was published and the terms of the sale were met",
    "The version shown at the conference was under construction",
    "A person may obtain a copy of the file from the office without charge",
)
CLASSES = (NONE, UNKNOWN, *TEMPLATES)


def split_words(text: Column) -> Column:
    """Runs of letters and digits, in lower case; the first or last may be
    empty."""
    return F.split(F.lower(text), r"[^\p{L}\p{N}]+")


def words(text: Column) -> Column:
    return F.filter(split_words(text), lambda w: w != "")


def plain_words(text: str) -> list[str]:
    return "".join(c.lower() if c.isalnum() else " " for c in text).split()


def windows(docs: DataFrame, text_col: str = "text", telling: list[str] | None = None) -> DataFrame:
    """A row for each window of each line, and of the joined lines of each
    paragraph of several: the columns of ``docs`` but the text,
    ``paragraph``, ``line`` (number in the paragraph, -1 for the joined
    lines), ``window``, ``words``.  ``telling``: only windows with one of
    these words."""
    def tells(w: Column) -> Column:
        return F.arrays_overlap(w, F.array(*[F.lit(x) for x in telling]).cast("array<string>")) if telling is not None else F.lit(True)

    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    blocks = docs.select(*rest, F.posexplode(F.split(F.col(f"`{text_col}`"), r"\n\s*\n")).alias("paragraph", "block"))
    # explode(array(x)) keeps x from being evaluated anew for every use
    blocks = blocks.filter(tells(split_words(F.col("block")))).select(
        *rest, "paragraph", "block", F.explode(F.array(F.split("block", "\n"))).alias("lines"))
    whole = F.when(F.size("lines") > 1, F.array(F.struct(F.lit(-1).alias("line"), F.col("block").alias("text")))).otherwise(F.array())
    parts = F.concat(F.transform("lines", lambda x, i: F.struct(i.alias("line"), x.alias("text"))), whole)
    lines = blocks.select(*rest, "paragraph", F.inline(parts).alias("line", "part"))
    lines = lines.select(*rest, "paragraph", "line", F.explode(F.array(words(F.col("part")))).alias("all")).filter(F.size("all") >= 1)
    lines = lines.filter(tells(F.col("all")))
    step = WINDOW // 2
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - step - 1, F.lit(0)), F.lit(step))
    cut = lines.select(*rest, "paragraph", "line", "all", F.explode(starts).alias("window"))
    cut = cut.select(*rest, "paragraph", "line", "window", F.slice("all", F.col("window") + 1, F.lit(WINDOW)).alias("words"))
    return cut.filter(tells(F.col("words")))


def _triples(words: Column) -> Column:
    return F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words) - 2, F.lit(1))), lambda i: F.array_join(F.slice(words, i, 3), " ")))


def _template_triples(texts_of: dict[str, tuple[str, ...]] = TEMPLATES) -> Column:
    """The templates: an array of (family, triples).  A constant, so that
    comparing with it takes a small expression."""
    rows = []
    for k, texts in enumerate(texts_of.values()):
        for t in texts:
            w = plain_words(t)
            own = sorted({" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))})
            rows.append(F.struct(F.lit(k).alias("family"), F.array(*[F.lit(x) for x in own]).alias("triples")))
    return F.array(*rows)


def _features(df: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``words`` to sparse counts of the words and word pairs listed."""
    pairs = NGram(n=2, inputCol="words", outputCol="pairs").transform(df)
    both = pairs.withColumn("grams", F.concat("words", "pairs"))
    counts = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features")
    return counts.transform(both).drop("pairs", "grams")


def _fixed() -> Column:
    """The fixed texts: an array of (label, words)."""
    rows = [(c, t) for c, texts in {**TEMPLATES, UNKNOWN: OTHER_LICENCES, NONE: ORDINARY}.items() for t in texts]
    return F.array(*[F.struct(F.lit(float(CLASSES.index(c))).alias("label"), words(F.lit(t)).alias("words")) for c, t in rows])


@dataclass
class Classifier:
    model: LogisticRegressionModel
    vocabulary: list[str]
    telling: list[str]
    threshold: float


def _ordinary(windows: DataFrame, alike: bool = False) -> DataFrame:
    """Windows that are not like a fixed licence text, of a known family or
    of none (``alike``: those that are).  Those without any of their triples need no comparison."""
    own = sorted({" ".join(w[i:i + 3]) for t in _licence_texts() for w in [plain_words(t)] for i in range(max(1, len(w) - 2))})
    some = windows.select("*", F.explode(F.array(_triples(F.col("words")))).alias("__have"))
    templates = _template_triples({**TEMPLATES, UNKNOWN: OTHER_LICENCES})
    shares = F.transform(templates, lambda t: F.size(F.array_intersect(F.col("__have"), t["triples"])) / F.size(t["triples"]))
    near = F.when(F.arrays_overlap("__have", F.array(*[F.lit(x) for x in own])), F.array_max(shares)).otherwise(0.0)
    return some.filter(near >= 0.5 if alike else near < 0.5).drop("__have")


def _licence_texts() -> list[str]:
    return [t for group in (*TEMPLATES.values(), OTHER_LICENCES) for t in group]


def _anchors(counts: dict[str, int]) -> list[str]:
    """Words, rare ones first, of which each window like a fixed licence text
    has one: without them, under half of a text's triples are left."""
    found: set[str] = set()
    for t in _licence_texts():
        w = plain_words(t)
        triples = {tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))}
        for x in sorted(set(w), key=lambda x: (len(x) < 2, counts.get(x, 0), x)):
            if 2 * sum(found.isdisjoint(y) for y in triples) < len(triples):
                break
            found.add(x)
    return sorted(found)


def telling_words(docs: DataFrame) -> tuple[list[str], int]:
    """Words of the fixed licence texts that at most ``COMMON`` of the
    ordinary windows have, and the number of these windows: counts of all
    windows less those of windows like a fixed text."""
    known = sorted({w for t in _licence_texts() for w in plain_words(t) if len(w) > 1})

    def count(of: DataFrame) -> dict[str, int]:
        # "" stands for the window itself
        own = F.array_intersect("words", F.array(*[F.lit(w) for w in known]))
        held = of.select(F.explode(F.concat(F.array(F.lit("")), own)).alias("w")).groupBy("w").count()
        return {r["w"]: r["count"] for r in held.collect()}

    every = count(windows(docs))
    alike = count(_ordinary(windows(docs, telling=_anchors(every)), alike=True))
    counts = {w: n - alike.get(w, 0) for w, n in every.items()}
    total = counts.get("", 0)
    return [w for w in known if counts.get(w, 0) <= COMMON * total], total


def vocabulary_of(telling: list[str]) -> list[str]:
    """Words and pairs of the fixed texts that hold a telling word."""
    found, tell = set(), set(telling)
    for texts in (*TEMPLATES.values(), OTHER_LICENCES, ORDINARY):
        for t in texts:
            w = plain_words(t)
            found |= {x for x in w if x in tell} | {f"{a} {b}" for a, b in zip(w, w[1:]) if a in tell or b in tell}
    return sorted(found)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS,
          sample_windows: int = SAMPLE_WINDOWS) -> Classifier:
    """Fits and calibrates the classifier."""
    spark = docs.sparkSession
    two = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    total = two.count()
    top = -2.0 ** 63 + 2.0 ** 64 * min(1.0, sample_docs / max(total, 1))
    picked = two.filter(F.xxhash64(F.col("id").cast("string")).cast("double") <= top)
    ordinary = _ordinary(windows(picked)).select(F.xxhash64("words").alias("h"), "words").orderBy("h").limit(sample_windows)
    ordinary = materialize(ordinary, "ordinary_windows")
    # a licence line may stand beside other text: each fixed text alone, and
    # before and after the first words of some ordinary windows
    beside = ordinary.filter(F.size("words") >= 8).orderBy("h").limit(30).select(
        F.slice("words", 1, 20).alias("near"), F.explode(_fixed()).alias("t"))
    mixed = beside.select("t.label", F.explode(F.array(
        F.concat("t.words", "near"), F.concat("near", "t.words"))).alias("words"))
    alone = spark.range(20, numPartitions=1).select(F.explode(_fixed()).alias("t")).select("t.label", "t.words")
    learn = ordinary.filter(F.pmod("h", F.lit(4)) != 0).select(F.lit(0.0).alias("label"), "words")
    # a paragraph without any feature is ordinary, whatever the sample holds
    bare = spark.range(500, numPartitions=1).select(F.lit(0.0).alias("label"), F.array(F.lit("-")).alias("words"))
    rows = alone.unionByName(mixed).unionByName(learn).unionByName(bare)
    balance = F.when(F.col("label") == 0, 1.0).otherwise(2.0)
    telling, n_ordinary = telling_words(two)
    vocabulary = vocabulary_of(telling)
    rows = materialize(_features(rows, vocabulary).select("label", "features", balance.alias("weight")).coalesce(2), "licence_training")
    fitted = LogisticRegression(family="multinomial", weightCol="weight", regParam=1e-3, maxIter=60, tol=1e-5).fit(rows)
    # calibration: the score that all but FALSE_ALARMS of all ordinary windows
    # stay under that training has not seen, and one without any feature (the
    # intercepts alone), which is that of windows without a telling word
    seen = learn.select(F.xxhash64("words").alias("h")).distinct()
    heard = _ordinary(windows(two, telling=telling)).withColumn("h", F.xxhash64("words"))
    unseen = heard.join(F.broadcast(seen), "h", "left_anti")  # at most ``sample_windows`` hashes
    scores = fitted.transform(_features(unseen, vocabulary)).select((1 - F.get(vector_to_array("probability"), 0)).alias("p"))
    scores = materialize(scores, "ordinary_scores")
    n_heard, over = scores.count(), FALSE_ALARMS * n_ordinary
    worst = 0.0
    if n_heard > over:
        worst = scores.agg(F.percentile_approx("p", 1 - over / n_heard, 10000).alias("q")).first()["q"] or 0.0
    odds = [math.exp(v) for v in fitted.interceptVector]
    threshold = max(0.5, worst * 1.05, (1 - odds[0] / sum(odds)) * 1.05)
    return Classifier(fitted, vocabulary, telling, min(0.99, threshold))


def _held(df: DataFrame) -> DataFrame:
    """Adds ``held``: (family, share, of) for each template: the share of its
    triples that ``words`` hold, and the share of the triples of ``words``
    that are its."""
    d = df.select("*", F.explode(F.array(_triples(F.col("words")))).alias("__have"))

    def one(t: Column) -> Column:
        both = F.size(F.array_intersect(F.col("__have"), t["triples"]))
        return F.struct(t["family"].alias("family"), (both / F.size(t["triples"])).alias("share"), (both / F.size("__have")).alias("of"))
    return d.select("*", F.explode(F.array(F.transform(_template_triples(), one))).alias("held")).drop("__have")


def find_licences(docs: DataFrame, found: Classifier | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per window that speaks of a licence, and family it names:
    ``doc_id``, ``paragraph`` (number from 0), ``line`` (in the paragraph, -1
    for its joined lines), ``window`` (first word), ``family``, ``score`` and
    ``similarity``."""
    c = found or train(docs, id_col, text_col)
    two = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    scored = c.model.transform(_features(windows(two, telling=c.telling), c.vocabulary)).withColumn("p", vector_to_array("probability"))
    hits = scored.filter(1 - F.get("p", 0) >= c.threshold).select("doc_id", "paragraph", "line", "window", "words", "p")
    known = F.slice("p", 3, len(TEMPLATES))
    best = F.array_position(known, F.array_max(known)).cast("int") - 1
    hits = _held(hits.select("*", best.alias("best"), (1 - F.get("p", 0)).alias("score")))
    # the likeliest family, if confirmed, and others with a whole template
    named = F.filter("held", lambda h: ((h["family"] == F.col("best")) & (h["share"] >= CONFIRM)) | (h["share"] == 1))
    own = F.filter("held", lambda h: h["family"] == F.col("best"))
    hits = hits.select("*", named.alias("named"), F.array_max(F.transform(own, lambda h: h["share"])).alias("nearest"))
    # an unconfirmed line is part of a wrapped licence if most of it is a
    # template's that the joined lines confirm; unconfirmed joined lines say
    # nothing that a line or a family of the paragraph has not said
    here = Window.partitionBy("doc_id", "paragraph")
    families = F.transform("named", lambda h: h["family"])
    hits = hits.select("*", F.array_distinct(F.flatten(F.collect_list(F.when(F.col("line") < 0, families)).over(here))).alias("joined"),
                       F.max((F.col("line") >= 0) | (F.size("named") > 0)).over(here).alias("said"))
    part = F.exists("held", lambda h: (h["of"] >= 0.5) & F.array_contains("joined", h["family"]))
    due = (F.size("named") > 0) | F.when(F.col("line") < 0, ~F.col("said")).otherwise(~part)
    none = F.array(F.struct(F.lit(-1).alias("family"), F.col("nearest").alias("share"), F.lit(0.0).alias("of")))
    hits = hits.filter(due).select("*", F.inline(F.when(F.size("named") > 0, F.col("named")).otherwise(none)).alias("k", "share", "of"))
    hits = hits.groupBy("doc_id", "paragraph", "line", "window", "k", "score").agg(F.max("share").alias("similarity"))
    family = F.when(F.col("k") >= 0, F.get(F.array(*[F.lit(f) for f in TEMPLATES]), F.col("k")))
    return hits.select("doc_id", "paragraph", "line", "window", F.coalesce(family, F.lit(UNKNOWN)).alias("family"), "score", "similarity")


def licences(docs: DataFrame, found: Classifier | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``licences`` (families in order of
    name, comma-joined; unknown ones too), ``n_paragraphs`` that name one and
    the highest ``score``."""
    hits = find_licences(docs, found, id_col, text_col).groupBy("doc_id").agg(
        F.array_join(F.array_sort(F.collect_set("family")), ",").alias("licences"),
        F.count_distinct("paragraph").alias("n_paragraphs"), F.max("score").alias("score"))
    hits = materialize(hits.withColumnRenamed("doc_id", "hit_id"), "licence_hits")
    ids = docs.select(F.col(f"`{id_col}`").alias("doc_id"))
    out = ids.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")), "left")
    return out.select("doc_id", F.coalesce("licences", F.lit("")).alias("licences"),
                      F.coalesce("n_paragraphs", F.lit(0)).cast("long").alias("n_paragraphs"),
                      F.coalesce("score", F.lit(0.0)).alias("score"))
