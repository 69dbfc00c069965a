"""Regular-expression spans with code-point offsets, in DataFrame functions.

Spark returns the matched strings of a pattern (``regexp_extract_all``) but
not where they stand.  ``split`` by the same pattern returns the pieces
between the matches, so the lengths of both, summed, are the offsets.  Both
functions run the same left-to-right search in the JVM; ``length`` counts
code points.

A rule's ``pattern`` must not match the empty string.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "array<struct<kind:string,rank:int,start:int,end:int,match:string>>"
BLOCK = 256


@dataclass(frozen=True)
class Rule:
    """``needle``: a string that every match holds (None: no such string);
    ``valid``: a check on the matched string; matches that fail it are
    dropped and not searched again."""

    kind: str
    pattern: str
    needle: str | None = None
    valid: Callable[[Column], Column] | None = None
    version: str = "1"

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


def held(df: DataFrame, name: str, values: dict[str, Column]) -> DataFrame:
    """``df`` and the struct ``name`` of ``values``, worked out once a row.
    What reads it inside a lambda reads a column: a projection would be
    written into the lambda and worked out for every element."""
    return df.select("*", F.explode(F.array(F.struct(*[v.alias(c) for c, v in values.items()]))).alias(name))


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda acc, x: acc + x)


def _block_sums(steps: Column) -> Column:
    """Sums of the steps before each block of ``BLOCK``."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(steps) / BLOCK).cast("int")),
                         lambda b: _total(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK))))
    return F.aggregate(blocks, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def _running_sum(steps: Column, sums: Column) -> Column:
    """Inclusive running sum of an array of ints, with its block sums."""
    return F.transform(steps, lambda _, i: F.get(sums, F.floor(i / BLOCK).cast("int"))
                       + _total(F.slice(steps, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK + 1)))


#: Code points in a chunk of a text.
CHUNK = 4096


def chunks(text: Column) -> Column:
    """``text`` in pieces of ``CHUNK`` code points: what is taken out of it
    at an offset need not be counted from its start."""
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % CHUNK), F.lit(0))


def between(pieces: Column, start: Column, end: Column) -> Column:
    """The text from ``start`` to ``end`` (exclusive, not before ``start``;
    beyond the text's end: up to there)."""
    first = F.floor(start / CHUNK).cast("int")
    some = F.slice(pieces, first + 1, F.floor(end / CHUNK).cast("int") - first + 1)
    return F.substring(F.array_join(some, ""), start - first * CHUNK + 1, end - start)


def _steps(matches: Column, gaps: Column) -> Column:
    """From the start of one match to the start of the next."""
    return F.transform(matches, lambda _, i: F.get(gaps, i) + F.when(
        i > 0, F.length(F.get(matches, i - 1))).otherwise(0))


def _made(rule: Rule, rank: int, matches: Column, starts: Column) -> Column:
    spans = F.transform(matches, lambda x, i: F.struct(
        F.lit(rule.kind).alias("kind"), F.lit(rank).alias("rank"), F.get(starts, i).alias("start"),
        (F.get(starts, i) + F.length(x)).alias("end"), x.alias("match")))
    if rule.valid:
        spans = F.filter(spans, lambda z: rule.valid(z["match"]))
    return F.when(starts.isNotNull(), spans.cast(SPAN)).otherwise(F.array().cast(SPAN))


def find_spans(df: DataFrame, text: str, rules: Sequence[Rule], out: str = "spans",
               wanted: Callable[[Rule], Column] | None = None) -> DataFrame:
    """Adds ``out``: the spans of all rules by rule, then start.  A null
    text has none.  ``wanted(rule)``: rows that the rule is to search."""
    names = [c for c in df.columns if c != out]
    found = []
    for r in rules:
        hit = F.regexp_extract_all(F.col(text), F.lit(r.pattern), F.lit(0))
        conds = [F.contains(F.col(text), F.lit(r.needle))] if r.needle else []
        conds += [wanted(r)] if wanted else []
        for c in conds:
            hit = F.when(c, hit)
        found.append(hit.alias(f"__m_{r.kind}"))
    d = df.select("*", *found)
    d = d.select("*", *[
        F.when(F.size(F.col(f"__m_{r.kind}")) > 0,
               F.transform(F.split(F.col(text), r.pattern, -1), lambda g: F.length(g))).alias(f"__g_{r.kind}")
        for r in rules])
    d = d.select("*", *[F.when(F.col(f"__g_{r.kind}").isNotNull(),
                               _steps(F.col(f"__m_{r.kind}"), F.col(f"__g_{r.kind}"))).alias(f"__t_{r.kind}")
                        for r in rules])
    d = held(d, "__sums", {r.kind: F.when(F.col(f"__t_{r.kind}").isNotNull(), _block_sums(F.col(f"__t_{r.kind}"))) for r in rules})
    d = d.select("*", *[F.when(F.col(f"__t_{r.kind}").isNotNull(), _running_sum(F.col(f"__t_{r.kind}"), F.col("__sums")[r.kind]))
                        .alias(f"__s_{r.kind}") for r in rules])
    each = [_made(r, k, F.col(f"__m_{r.kind}"), F.col(f"__s_{r.kind}")) for k, r in enumerate(rules)]
    return d.select(*[F.col(f"`{c}`") for c in names], F.concat(*each).alias(out))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda z: F.concat_ws(
        ":", z["kind"], z["start"].cast("string"), z["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda z: z["kind"] == kind)).cast("long")


def only(spans: Column, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda z: z["kind"].isin(*kinds))


def by_start(spans: Column) -> Column:
    """Spans in order of start, then rule."""
    return F.array_sort(spans, lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
                        .otherwise(a["rank"] - b["rank"]))
