"""Registered queries of the operators in this folder: each applies its
operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import dedup, embeddings, langid, licenses, linededup, mixing, packing, phrases, pieces, pii, secrets, simhash, turns
from ticklake.llm.oracle import ORACLE_SQL  # noqa: F401


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.scan_secrets(documents(spark, sf_dir)))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), with_ids=False)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licences(documents(spark, sf_dir))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_digest(simhash.near_duplicates(documents(spark, sf_dir)))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(documents(spark, sf_dir))
    return out.select("doc_id", "text", "lines_removed")


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.encode_checked(documents(spark, sf_dir))
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), "round_trip")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = documents(spark, sf_dir).select("doc_id", "text")
    return pii.pii_digest(pii.find_pii(two))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))
    out = langid.predict(docs, model)
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair_conversations(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_secrets, op2_exact_dedup, op3_packing, op4_licenses, op5_simhash, op6_line_dedup, op7_embeddings, op8_pieces,
    op9_pii, op10_language, op11_mixing, op12_conversations, op13_phrases)}
