"""Operator 9: personal data by patterns, checksums and context.

Regular expressions propose spans; validators confirm them (Luhn for cards,
mod-97 for IBANs, number ranges and digit counts for addresses and phones);
words near a span raise its score.  DataFrame functions only; nothing is
shuffled: each text is read once, in the task that scans it.

Defined results: null text counts as empty and has no span; every input row
gives one row, whatever its id; other columns are kept by ``redact``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.spans import BLOCK, Rule, between, chunks, count_kind, find_spans, held, joined, only

BASE = ("email", "ip", "card", "phone")

# Words that stand near personal data, and the base score of each kind.
CONTEXT = {
    "email": ("mail", "contact", "correo", "kontakt"),
    "ip": ("ip", "address", "host", "server", "adresse", "direccion"),
    "card": ("card", "visa", "credit", "carte", "karte", "tarjeta"),
    "phone": ("phone", "call", "tel", "fax", "mobile", "telefon", "telefono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
}
SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.95}
BONUS = 0.1
REACH = 40


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """True if the digits of ``m`` pass the Luhn checksum."""
    d = F.reverse(F.split(digits(m), ""))
    total = F.aggregate(
        F.transform(F.filter(d, lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))),
        F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def mod97(m: Column) -> Column:
    """True if ``m``, an IBAN with or without spaces, leaves 1 modulo 97."""
    plain = F.upper(F.regexp_replace(m, r"\x20", ""))
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    chars = F.filter(F.split(turned, ""), lambda c: c != "")
    rest = F.aggregate(chars, F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))
    return rest == 1


def _digits_between(lo: int, hi: int):
    return lambda m: F.length(digits(m)).between(lo, hi)


# The look-behinds and possessive repeats leave the leftmost greedy matches
# as they are (no class holds what follows it) and keep the search linear in
# the text; \G lets a match begin where the one before it ended.  A card
# match of fewer than 16 digits would be dropped, so it is not made.
RULES = (
    Rule("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Rule("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".",
         lambda m: m.rlike(r"^(?:0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5]|)(?:\.|$)){4}$")),
    Rule("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,}+", None,
         lambda m: F.length(digits(m)).between(16, 19) & luhn(m)),
    Rule("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", _digits_between(8, 15)),
    Rule("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])", None,
         lambda m: F.length(F.regexp_replace(m, r"\x20", "")).between(15, 34) & mod97(m)),
)


def _score(pieces: Column, z: Column) -> Column:
    """Base score of the kind; more if a context word stands within
    ``REACH`` code points before or after the span."""
    near = F.lower(F.concat(between(pieces, F.greatest(z["start"] - REACH, F.lit(0)), z["start"]), F.lit(" "),
                            between(pieces, z["end"], z["end"] + REACH)))
    score = None
    for kind, words in CONTEXT.items():
        one = F.lit(SCORE[kind]) + F.when(near.rlike(r"\b(?:" + "|".join(words) + r")\b"), BONUS).otherwise(0.0)
        score = F.when(z["kind"] == kind, one) if score is None else score.when(z["kind"] == kind, one)
    return F.least(score.otherwise(F.lit(0.5)), F.lit(1.0))


def find_pii(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES,
             min_score: float = 0.0, out: str = "spans") -> DataFrame:
    """All columns of ``docs`` and ``out``: spans of (kind, rank, start,
    end, match, score), by kind, then start.  ``min_score`` drops spans
    below it; 0 keeps all confirmed spans."""
    d = find_spans(docs, text_col, rules, out)
    some = F.when(F.size(out) > 0, chunks(F.col(f"`{text_col}`")))
    d = held(d, "__text", {"pieces": some})
    scored = F.transform(F.col(out), lambda z: F.struct(
        z["kind"].alias("kind"), z["rank"].alias("rank"), z["start"].alias("start"), z["end"].alias("end"),
        z["match"].alias("match"), _score(F.col("__text.pieces"), z).alias("score")))
    kept = F.filter(scored, lambda z: z["score"] >= min_score) if min_score > 0 else scored
    return d.withColumn(out, kept).drop("__text")


def redact(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with every span of personal data in ``text_col`` replaced by
    its kind in brackets.  Overlapping spans become one, named by the first.
    Texts without spans, and nulls, stay as they are."""
    found = find_spans(docs, text_col, rules, "__spans")
    text = F.col(f"`{text_col}`")
    ordered = F.array_sort(F.col("__spans"), lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"])
                           .otherwise(b["end"] - a["end"]))
    found = held(found, "__text", {"pieces": F.when(F.size("__spans") > 0, chunks(text))})
    pieces, none = F.col("__text.pieces"), F.array().cast("array<string>")
    # parts are joined in groups, so that a step copies few of them
    start = F.struct(F.lit(0).alias("at"), none.alias("done"), none.alias("parts"))

    def step(acc: Column, z: Column) -> Column:
        piece = F.concat(between(pieces, acc["at"], z["start"]), F.lit("["), F.upper(z["kind"]), F.lit("]"))
        full = F.size(acc["parts"]) >= BLOCK
        new = z["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], z["end"]).alias("at"),
                        F.when(full, F.concat(acc["done"], F.array(F.array_join(acc["parts"], "")))).otherwise(acc["done"]).alias("done"),
                        F.concat(F.when(full, none).otherwise(acc["parts"]), F.when(new, F.array(piece)).otherwise(none)).alias("parts"))

    clean = F.aggregate(ordered, start, step, lambda acc: F.concat(
        F.array_join(acc["done"], ""), F.array_join(acc["parts"], ""), between(pieces, acc["at"], F.length(text))))
    new = F.when(F.size("__spans") > 0, clean).otherwise(text)
    return found.select(*[(new.alias(c) if c == text_col else F.col(f"`{c}`")) for c in docs.columns])


def pii_digest(found: DataFrame) -> DataFrame:
    """The columns of the contract, and the highest score of a document."""
    s = F.col("spans")
    return found.select("doc_id", *[count_kind(s, k).alias(f"n_{k}") for k in BASE],
                        F.sha2(joined(only(s, BASE)), 256).alias("base_sha256"),
                        joined(s).alias("spans"),
                        F.coalesce(F.array_max(F.transform(s, lambda z: z["score"])), F.lit(0.0)).alias("top_score"))
