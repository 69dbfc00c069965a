"""Operator 1: secret scans over an incremental blob ledger.

Every version of every document is content-addressed (SHA-256 of the
text).  Equal texts are one *blob*.  The ledger is a Parquet folder with one
row per blob and scan: the blob, the rules that were run on it (kind and
version) and the spans they found.  A run scans only pairs of blob and rule
version that the ledger lacks, appends what it found, and joins the findings
back to all documents that hold the blob.  Changing a rule's version, or
adding a rule, rescans with that rule only.

Main path: DataFrame functions only.  Texts are shuffled once, by blob, and
``dropDuplicates`` keeps one text per blob and map task first, so a group of
copies does not meet in one task.

Defined results: null text counts as empty; an empty table gives an empty
result; a null or repeated ``doc_id`` gives one row per input row; columns
of other names are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.spans import SPAN, Rule, by_start, count_kind, find_spans, joined, only
from ticklake.session import materialize, scratch_path

# The base patterns of the contract.
ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
BASE = ("assign", "access", "hex")

# hex: leftmost greedy runs of 24 or more are the maximal runs of that
# length; access: a run cut at its first AKIA is the longest there is.
RULES = (
    Rule("assign", ASSIGN, None, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", "AKIA"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", "gh"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "eyJ"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", "PRIVATE KEY"),
)
LEDGER = f"blob string, scanned array<string>, spans {SPAN}"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; one with no rows when nothing is there yet."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def update_ledger(docs: DataFrame, path: str, rules: Sequence[Rule] = RULES, text_col: str = "text") -> None:
    """Scans the unseen pairs of blob and rule version and appends them."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    blobs = docs.select(F.sha2(text, 256).alias("blob"), text.alias("text")).dropDuplicates(["blob"])
    keys = F.array(*[F.lit(r.key) for r in rules])
    seen = (read_ledger(spark, path).select("blob", F.explode("scanned").alias("__rule"))
            .groupBy("blob").agg(F.collect_set("__rule").alias("__have")))
    todo = (blobs.join(seen, "blob", "left")
            .select("blob", "text", F.array_except(keys, F.coalesce("__have", F.array().cast("array<string>")))
                    .alias("scanned"))
            .filter(F.size("scanned") > 0))
    scanned = find_spans(todo, "text", rules, wanted=lambda r: F.array_contains("scanned", r.key))
    scanned.select("blob", "scanned", "spans").write.mode("append").parquet(path)


def scan_secrets(docs: DataFrame, ledger: str | None = None, rules: Sequence[Rule] = RULES,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``blob`` and its ``spans`` (kind,
    start, end, match; by start).  ``ledger``: a folder that all executors
    share; None takes a new one."""
    spark = docs.sparkSession
    path = ledger or scratch_path(spark, "blob_ledger")
    update_ledger(docs, path, rules, text_col)
    now = [r.key for r in rules]
    kinds = [r.kind for r in rules]
    known = read_ledger(spark, path).filter(F.size("spans") > 0)
    # spans of scans with the present version of their rule
    live = F.filter("spans", lambda z: F.exists(
        F.col("scanned"), lambda k: k.isin(*now) & (F.substring_index(k, "@", 1) == z["kind"])) & z["kind"].isin(*kinds))
    found = materialize(known.groupBy("blob").agg(F.flatten(F.collect_set(live)).alias("spans")), "blob_findings")
    paths = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                        F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256).alias("blob"))
    out = paths.join(found, "blob", "left")
    return out.select("doc_id", "blob", by_start(F.coalesce("spans", F.array().cast(SPAN))).alias("spans"))


def secret_digest(found: DataFrame) -> DataFrame:
    """The columns of the contract from ``scan_secrets``."""
    s = F.col("spans")
    return found.select("doc_id", *[count_kind(s, k).alias(f"n_{k}") for k in BASE],
                        F.sha2(joined(only(s, BASE)), 256).alias("base_sha256"),
                        joined(s).alias("spans"))
