"""Operator 8: parity with the sentencepiece library, and round trips."""

import random

from pyspark.sql import functions as F

from ticklake.llm import pieces as P

EDGE = ["", " ", "  a", "a  b   c ", "日本語 x", "😀", "a\tb\n\nc", "▁x ▁▁y", "<s> </s> <unk>", "<0x41>", "\x00\x01", " " * 40 + "x", "é́", "a▁b",
        "x" * 3000, "\n", "\n a", "e  \n  f"]


def test_parity(spark):
    r, q = random.Random(1), random.Random(4)
    texts = EDGE + ["".join(r.choice("ab <>é▁\n\t日 s/0x41unk") for _ in range(r.randint(0, 60))) for _ in range(300)]
    texts += ["".join(q.choice("a ▁") for _ in range(q.randint(0, 70))) for _ in range(300)]
    texts += [" " * k + "x" + " " * (k * 7 % 90) + "y" for k in range(100)]
    texts += [x[0] for x in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    assert P.parity(texts) == []


def test_encode_and_decode_tables(docs_of):
    d = docs_of([*EDGE, None]).withColumn("ids", F.lit("x")).withColumn("c0", F.lit(1))
    out = P.decode(P.encode(d))
    assert out.columns == [*[c for c in d.columns if c != "ids"], "ids", "decoded"]
    rows = out.collect()
    # the mark itself decodes to a space; all else comes back as it was
    assert all((r.text or "").replace("▁", " ") == r.decoded for r in rows) and len(rows) == len(EDGE) + 1
    assert P.encode(docs_of([])).count() == 0
    checked = P.encode_checked(d).collect()
    assert all(r.round_trip for r in checked) and sorted((r.doc_id, r.ids) for r in checked) == sorted((r.doc_id, r.ids) for r in rows)
    assert P.encode_checked(docs_of([])).count() == 0


def test_protobuf_is_read_as_written():
    from sentencepiece import sentencepiece_model_pb2 as pb
    m, ours = pb.ModelProto(), P.read_model(P.public_model())
    with open(P.public_model(), "rb") as f:
        m.ParseFromString(f.read())
    assert ours.pieces == [(p.piece, p.score, p.type) for p in m.pieces]
    assert (ours.kind, ours.byte_fallback, ours.unknown) == (m.trainer_spec.model_type, m.trainer_spec.byte_fallback, m.trainer_spec.unk_id)
    n = m.normalizer_spec
    assert (ours.char_map, ours.dummy_prefix, ours.single_spaces, ours.escape) == (
        n.precompiled_charsmap, n.add_dummy_prefix, n.remove_extra_whitespaces, n.escape_whitespaces)


def test_unigram_model_takes_scores_as_they_are(tmp_path):
    """A small unigram model written by hand, against the library."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    for p, s, k in [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), ("▁", -2, 1), ("a", -3, 1), ("b", -3.5, 1), ("ab", -4, 1), ("▁ab", -5, 1), ("ba", -4.25, 1)]:
        m.pieces.add(piece=p, score=s, type=k)
    m.trainer_spec.model_type = 1
    m.normalizer_spec.name = "identity"
    m.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "m.model"
    path.write_bytes(m.SerializeToString())
    ours, theirs = P.Pieces(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))
    for t in ["ab", "abba", " ab  ba ", "aabb", "b", ""]:
        assert ours.encode([t])[0].tolist() == theirs.encode(t), t
