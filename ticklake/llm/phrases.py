"""Operator 13: phrase collocation mining by set-oriented relations (SETM).

The relation of length k holds the places where a frequent phrase of k words
stands, sorted by piece and position.  It is extended by a merge join with
itself: a phrase at a place and one at the next place make a phrase of k + 1
words.  Candidates are counted by group (phrase's first k words, last word)
in Spark, groups under ``support`` go, and the places are semi-joined with the
groups that stay; what is left is written and is the next relation.

A relation is stored in blocks: a row holds the places of about ``BLOCK`` bytes
of text of one language, in order, as arrays: each place's phrase, last word
and step from the place before.  The step is one between neighbouring words
and more between words of different pieces, so the merge join needs nothing
else.  A text longer than a block is cut between words; a block then also
holds the next four words, whose own phrases are counted in the block they
belong to.  A length's relation is deleted once the next one is written.

Groups are counted twice: by 64-bit id alone, which is all that is shuffled of
the many that are rare, then by the pair (prefix, last word) where the id's sum
has reached ``support``.  The second count is the phrase's.  Two frequent
phrases with one id stop the job with an error.

The semi-join looks ids up in a Bloom filter of the groups that stay, sized by
their number up to ``MAX_BITS``.  It only saves work: a place that passes
by mistake belongs to a group that the count of pairs drops.

Scale: words and groups are counted in each block before anything is shuffled;
every later table holds frequent phrases only, at most n / ``support`` of a
length.  No language is one task: blocks and groups are rows like any other,
and the final ranking of a language reads the best of ``SHARES`` shares.

Defined results: null text is empty and null language ``und``, which is the
language of that name; repeated rows count as often as they occur; texts
without words add nothing; an empty table gives an empty result; other columns
play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticklake.llm.arrow import bounded
from ticklake.llm.dedup import filter_of, positions
from ticklake.session import materialize, scratch_path

SUPPORT = 100
LONGEST = 5
TOP = 2000
SHARES = 16
#: Bytes of text in a block of a relation (a Parquet reader holds 4,096 rows at once) and of a count.
BLOCK, COUNT_BLOCK = 1 << 15, 1 << 22
MIN_BITS, MAX_BITS = 1 << 16, 1 << 28
SPACES, BREAKS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
ALL = 2 ** 31 - 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[list(SPACES)], _KIND[list(BREAKS)] = 1, 2
_NEXT = re.compile(rb"(?:[%b]*[^%b]+){0,%d}" % (re.escape(SPACES), re.escape(SPACES + BREAKS), LONGEST - 1))


def blocks_of(texts: pa.Array, size: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Bytes, first byte of each text in them, and how many of the bytes are
    the block's own (the rest are words to look ahead at)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(texts):
        j = max(int(np.searchsorted(at, at[i] + size, "right")) - 1, i + 1)
        part = data[at[i]:at[j]]
        if len(part) <= size:
            yield part, at[i:j] - at[i], len(part)
        else:
            yield from _long(part, size)
        i = j


def _long(data: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    first, one, raw = 0, np.zeros(1, np.int64), memoryview(data)
    while first < len(data):
        cut = first + size
        while cut < len(data):
            gaps = np.flatnonzero(_KIND[data[first:cut]])
            if len(gaps):
                cut = first + int(gaps[-1]) + 1
                break
            cut += size
        cut = min(cut, len(data))
        end = _NEXT.match(raw, cut).end()
        yield data[first:end], one, cut - first
        first = cut


def words_of(data: np.ndarray, texts: np.ndarray, own: int) -> tuple[pa.Array, np.ndarray, np.ndarray, int]:
    """The different words, each word's number among them, its position, and
    the position from which words are not the block's own."""
    low = _LOWER[data]
    kind = _KIND[low]
    is_word = kind == 0
    start = is_word.copy()
    start[1:] &= ~is_word[:-1]
    new = texts[texts < len(data)]
    start[new] = is_word[new]
    breaks = (kind == 2).astype(np.int32)
    np.add.at(breaks, new, 1)
    begin = np.flatnonzero(start)
    where = np.arange(len(begin), dtype=np.int32) + np.cumsum(breaks, dtype=np.int32)[begin]
    letters = low[is_word]
    offsets = np.append(np.cumsum(is_word, dtype=np.int64)[begin] - 1, len(letters))
    words = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
    mine = int(np.searchsorted(begin, own))
    limit = int(where[mine]) if mine < len(begin) else ALL
    return words.dictionary, words.indices.to_numpy(), where, limit


def _by_language(batch: pa.RecordBatch, size: int) -> Iterator[tuple[str, tuple]]:
    langs = batch.column("lang").dictionary_encode()
    codes = langs.indices.to_numpy()
    for k, lang in enumerate(langs.dictionary.to_pylist()):
        for block in blocks_of(batch.column("text").take(pa.array(np.flatnonzero(codes == k))), size):
            yield lang, words_of(*block)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lang, (words, codes, where, limit) in _by_language(b, COUNT_BLOCK):
            n = np.bincount(codes[where < limit], minlength=len(words))
            met = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(met), pa.string()), "word": words.take(pa.array(met)).cast(pa.string()), "n": pa.array(n[met])})


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def extended(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Ids of the phrases ``prefix`` + ``word``."""
    return _mixed(_mixed(prefix.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) ^ word.view(np.uint64)).view(np.int64)


class Kept:
    """The semi-join's filter, looked up in its packed form."""

    def __init__(self, data: np.ndarray, bits: int):
        self.words, self.bits = np.frombuffer(data, np.uint64), bits

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        at = positions(ids.view(np.uint64), self.bits)
        return ((self.words[(at >> np.uint64(6)).view(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


#: A block of a relation: ids of its phrases and of their last words (empty:
#: the phrases are words), the number of each place's phrase and last word among
#: them, the step from the place before, and how many places are the block's own.
RELATION = "lang string, own int, phrases binary, phrase binary, words binary, word binary, step binary"
NUMBER, STEP = np.uint16, np.uint8
#: Blocks whose places are counted at once.
ROWS = 128


class Blocks:
    """Blocks of a relation on their way to a batch of rows."""

    def __init__(self):
        self.rows: list[dict] = []

    def add(self, lang: str, own: int, where: np.ndarray, ids: np.ndarray, codes: np.ndarray,
            words: np.ndarray | None = None, word_codes: np.ndarray | None = None) -> None:
        """Places ``where`` of a block: at most BLOCK / 2 + LONGEST, so that
        their phrases have numbers of NUMBER's size."""
        row = {"lang": lang, "own": own}
        row["phrases"], row["phrase"] = self._packed(ids, codes)
        row["words"], row["word"] = (b"", b"") if words is None else self._packed(words, word_codes)
        steps = np.diff(where, prepend=where[0])
        row["step"] = np.minimum(steps, np.iinfo(STEP).max).astype(STEP).tobytes()
        self.rows.append(row)

    @staticmethod
    def _packed(values: np.ndarray, of: np.ndarray) -> tuple[bytes, bytes]:
        used, again = np.unique(of, return_inverse=True)
        return values[used].tobytes(), again.astype(NUMBER).tobytes()

    def batch(self) -> pa.RecordBatch:
        kinds = {"lang": pa.string(), "own": pa.int32()}
        made = pa.RecordBatch.from_pydict({c: pa.array([r[c] for r in self.rows], kinds.get(c, pa.binary())) for c in
                                           ("lang", "own", "phrases", "phrase", "words", "word", "step")})
        self.rows = []
        return made


def _first_relation(kept, bits: int, size: int):
    """Places of the words that stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stays, out = Kept(kept.value, bits), Blocks()
        for b in batches:
            for lang, (words, codes, where, limit) in _by_language(b, size):
                ids = word_ids(lang, words.to_pylist())
                at = np.flatnonzero(stays(ids)[codes]) if len(ids) else ()
                if len(at):
                    out.add(lang, int(np.searchsorted(where[at], limit)), where[at], ids, codes[at])
            yield out.batch()
    return run


def word_ids(lang: str, words: list[str]) -> np.ndarray:
    """Spark's ``xxhash64(lang, word)``."""
    seed = xxhash.xxh64_intdigest(lang, 42)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words)).view(np.int64)


def _joined(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The merge join of each block with itself: language, own pairs, places,
    prefix ids and their numbers, last words' ids and their numbers."""
    for row in batch.to_pylist():
        ids, codes = np.frombuffer(row["phrases"], np.int64), np.frombuffer(row["phrase"], NUMBER)
        words, word_codes = ((np.frombuffer(row["words"], np.int64), np.frombuffer(row["word"], NUMBER)) if row["words"]
                             else (ids, codes))
        step = np.frombuffer(row["step"], STEP)
        at = np.flatnonzero(step[1:] == 1)
        yield (row["lang"], int(np.searchsorted(at, row["own"])), np.cumsum(step, dtype=np.int64)[at], ids, codes[at],
               words, word_codes[at + 1])


def _count_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first in range(0, b.num_rows, ROWS):
            made = [np.zeros(0, np.int64)]
            for _, own, _, ids, codes, words, word_codes in _joined(b.slice(first, ROWS)):
                made.append(extended(ids[codes[:own]], words[word_codes[:own]]))
            met, n = np.unique(np.concatenate(made), return_counts=True)
            yield pa.RecordBatch.from_pydict({"id": pa.array(met), "n": pa.array(n)})


COUNTS = "lang string, id long, prefix long, word long, n long"


def _count_pairs(kept, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stays = Kept(kept.value, bits)
        for b in batches:
            rows = {"lang": [], "id": [], "prefix": [], "word": [], "n": []}
            for lang, own, _, ids, codes, words, word_codes in _joined(b):
                pairs, n = np.unique(codes[:own].astype(np.int64) * len(words) + word_codes[:own], return_counts=True)
                prefix, word = ids[pairs // max(len(words), 1)], words[pairs % max(len(words), 1)]
                made = extended(prefix, word)
                at = np.flatnonzero(stays(made))
                rows["lang"].append(np.full(len(at), lang, object))
                for c, v in (("id", made), ("prefix", prefix), ("word", word), ("n", n)):
                    rows[c].append(v[at])
            if rows["lang"]:
                yield pa.RecordBatch.from_pydict({
                    c: pa.array(np.concatenate(v), pa.string() if c == "lang" else pa.int64()) for c, v in rows.items()})
    return run


def _next_relation(kept, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stays, out = Kept(kept.value, bits), Blocks()
        for b in batches:
            for lang, own, where, ids, codes, words, word_codes in _joined(b):
                if not len(where):
                    continue
                pairs, which = np.unique(codes.astype(np.int64) * len(words) + word_codes, return_inverse=True)
                made = extended(ids[pairs // len(words)], words[pairs % len(words)])
                at = np.flatnonzero(stays(made)[which])
                if len(at):
                    out.add(lang, int(np.searchsorted(at, own)), where[at], made, which[at], words, word_codes[at])
            yield out.batch()
    return run


def _filter(groups: DataFrame) -> tuple[object, int] | None:
    """The broadcast filter of the groups' ids and its size; None if there
    are no groups."""
    n = groups.count()
    if not n:
        return None
    bits = min(max(MIN_BITS, 1 << (16 * n - 1).bit_length()), MAX_BITS)
    data = filter_of(groups.select(F.col("id").alias("hash")), bits)
    return groups.sparkSession.sparkContext.broadcast(data), bits


def _one_id(groups: DataFrame) -> DataFrame:
    """``groups``, after a check that no two share an id."""
    if groups.groupBy("id").count().filter("count > 1").limit(1).count():
        raise ValueError("two frequent phrases share an id; change the hash seed")
    return groups


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A relation, compressed, in the shared checkpoint folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path), path


def _delete(df: DataFrame, path: str) -> None:
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                     longest: int = LONGEST, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of up to ``longest`` words with
    f >= ``support``, and (lang, n) of all languages."""
    if longest > LONGEST or block > BLOCK:
        raise ValueError(f"phrases have at most {LONGEST} words, blocks at most {BLOCK} bytes")
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").alias("text"))
    texts = bounded(texts)
    words = materialize(texts.mapInArrow(_count_words, "lang string, word string, n long")
                        .groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    one = materialize(words.filter(F.col("n") >= support).select(
        "lang", F.xxhash64("lang", "word").alias("id"), "word", F.col("n").alias("f")), "frequent_words")
    found = one.select("lang", "id", F.col("word").alias("phrase"), F.lit(1).alias("words"), "f")
    last, every = found, [found]
    kept = _filter(_one_id(one))
    if kept:
        relation, path = _written(texts.mapInArrow(_first_relation(*kept, block), RELATION), "places_1")
    for k in range(2, longest + 1):
        if not kept:
            break
        sums = relation.mapInArrow(_count_ids, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
        kept = _filter(materialize(sums.filter(F.col("n") >= support).select("id"), f"ids_{k}"))
        if not kept:
            break
        counts = relation.mapInArrow(_count_pairs(*kept), COUNTS).groupBy("lang", "id", "prefix", "word").agg(F.sum("n").alias("f"))
        groups = _one_id(materialize(counts.filter(F.col("f") >= support), f"frequent_{k}"))
        spelled = (groups.join(last.select(F.col("id").alias("prefix"), F.col("phrase").alias("head")), "prefix")
                   .join(one.select(F.col("id").alias("word"), F.col("word").alias("tail")), "word"))
        last = materialize(spelled.select("lang", "id", F.concat_ws(" ", "head", "tail").alias("phrase"),
                                          F.lit(k).alias("words"), "f"), f"phrases_{k}")
        every.append(last)
        old = path  # every reader of it has run
        if k < longest:
            relation, path = _written(relation.mapInArrow(_next_relation(*kept), RELATION), f"places_{k}")
        _delete(docs, old)
    out = every[0]
    for d in every[1:]:
        out = out.unionByName(d)
    return out.drop("id"), totals


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, words, a) with their lowest-scoring cut: l, r,
    n, score."""
    cand = phrases.filter("words > 1").withColumnRenamed("f", "a")
    parts = F.split("phrase", " ", -1)
    cuts = cand.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("*", F.concat_ws(" ", F.slice(parts, F.lit(1), F.col("k"))).alias("first"),
                       F.concat_ws(" ", F.slice(parts, F.col("k") + 1, F.col("words") - F.col("k"))).alias("rest"))
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.join(totals, "lang")
    # whole numbers of up to 38 digits
    score = F.expr("(CAST(a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(19, 0)) * 1000) div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")
    best = cuts.groupBy("lang", "phrase", "words", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")


def uncovered(cand: DataFrame) -> DataFrame:
    """Candidates that no longer candidate holds as often as they occur."""
    parts = F.split("phrase", " ", -1)
    at = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.col("words") - size + 1), lambda i: F.concat_ws(" ", F.slice(parts, i, size)))))
    inner = cand.filter("words > 2").select("lang", F.explode(at).alias("phrase"), F.col("a").alias("longer"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    met = cand.join(inner, ["lang", "phrase"], "left")
    return met.filter(F.coalesce(F.col("longer"), F.lit(0)) * 100 < F.col("a") * 100).drop("longer")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                 longest: int = LONGEST, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """Each language's ``top`` phrases by score."""
    phrases, totals = frequent_phrases(docs, text_col, lang_col, support, longest, block)
    cand = uncovered(materialize(scored(phrases, totals), "scored"))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # a share's best first, so that a language's last ranking reads SHARES * top rows at most
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    cand = cand.withColumn("nth", F.row_number().over(Window.partitionBy("lang", share).orderBy(*order))).filter(F.col("nth") <= top)
    w = Window.partitionBy("lang").orderBy(*order)
    ranked = cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
