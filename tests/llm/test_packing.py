"""Operator 3 against the tokenizers library run on whole texts."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ticklake.llm.packing import MAX_LEN, cut, pack, public_path, write_buckets
from ticklake.session import scratch_path

EDGE = [None, "", " ", "\n\t", "it's we'll DON'T 'S", "É È ß ñ ÄÖÜ ŒUVRE İstanbul ΟΔΟΣ", "é Éx ́", "x..y ... foo!. bar., a,b,",
        "<|endoftext|> and <|ENDOFTEXT|> x<|startoftext|>y", "日本語 テキスト 한글", "a b c\x1cd\x0be", "1234 12a a12 ½ ² Ⅷ", "𝒳𝒴 😀😀 👩‍👩‍👧",
        "Kelvin K Ω ª º µ", "ſtop ﬁn Ǆ", "word " * 5000, "y" * 20000, "don't. it's, '.", "\r\n a\rb"]


def test_ids_pieces_and_lengths(spark, docs_of):
    real = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    r = random.Random(2)
    chars = "abcdeE 'sßéÉñ.,!\n\t́İΣ1<|>"
    texts = EDGE + real + ["".join(r.choice(chars) for _ in range(r.randint(0, 120))) for _ in range(600)]
    model = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    rows = pack(docs_of(texts)).collect()
    by = {}
    for x in rows:
        by.setdefault(x.doc_id, []).append(x)
    assert len(by) == len(texts) and len({x.sequence_id for x in rows}) == len(rows)
    for i, t in enumerate(texts):
        want = model.encode(t or "", add_special_tokens=False).ids + [1]
        at = 0
        for x in sorted(by[i], key=lambda x: x.start):
            ids = want[x.start:x.start + x.length]
            assert x.start == at and x.length & (x.length - 1) == 0 and x.length <= MAX_LEN and x.offset == 0
            assert x.input_ids == ids and x.doc_tokens == len(want), (i, (t or "")[:80])
            assert x.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
            at += x.length
        assert at == len(want)


def test_cut():
    assert cut(0) == [] and cut(1) == [(0, 1)] and cut(2048) == [(0, 2048)]
    assert cut(4096 + 5) == [(0, 2048), (2048, 2048), (4096, 4), (4100, 1)]


def test_odd_tables_and_buckets(spark, docs_of):
    assert pack(docs_of([])).count() == 0
    d = docs_of([(None, "a b"), (1, "a b"), (1, "a b")]).withColumn("length", F.lit("x")).withColumn("start", F.lit(0))
    rows = pack(d)
    assert rows.count() == 6 and rows.select("sequence_id").distinct().count() == 6
    path = scratch_path(spark, "buckets")
    write_buckets(rows, path)
    assert sorted(r[0] for r in spark.read.parquet(path).select("bucket").distinct().collect()) == [1, 2]
