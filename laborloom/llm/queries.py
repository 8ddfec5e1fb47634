"""The registered queries of the operators: thin digests of what the operators return."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborloom.llm import (
    bpe, chat_trees, chunked_bpe, exact_dedup, fingerprints, hard_negatives, license_scan, minhash_dedup, packing,
    periodic_runs, secret_scan, substring_dedup, toxicity)
from laborloom.llm.shared import documents

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
Query = Callable[[SparkSession, str], DataFrame]


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_editions(documents(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), VOCABULARY)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return secret_scan.scanned(docs, secret_scan.network(docs))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(documents(spark, sf_dir))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.deduplicated(documents(spark, sf_dir), digest=True)
    return kept.withColumnRenamed("kept", "kept_sha256")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scanned(documents(spark, sf_dir))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"),
                        F.array_join("licences", ",").alias("licences"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encoded(documents(spark, sf_dir), VOCABULARY), VOCABULARY)


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(documents(spark, sf_dir), words=4, percent=80)


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    chats = chat_trees.conversations(chat_trees.linear_trees(given.unionByName(added)))
    read = chats.select("tree_id", "formatted", chat_trees.turns_read(F.col("formatted")).alias("turns"),
                        chat_trees.loss_read(F.col("segments")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    sha = lambda text: F.sha2(F.encode(text, "UTF-8"), 256)
    return read.select(
        F.col("tree_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        sha(F.array_join(lines, "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), sha(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op11_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(vectors, F.col("vec_id") % 100 == 0, label)


def op12_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunked_bpe.digests(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)


def looped(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of every tenth document, by a hash of its id, with a loop from some word on."""
    if doc_id is None or not words:
        return words
    rest, h = zlib.crc32(str(doc_id).encode()) // 10, zlib.crc32(str(doc_id).encode()) % 10
    if h:
        return words
    first = rest % len(words)
    period = 1 + (len(words) - first) // (3 + rest % 8)
    return words[:first] + [words[first + (i - first) % period] for i in range(first, len(words))]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.detected(documents(spark, sf_dir), looped)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    sha = lambda text: F.sha2(F.encode(text, "UTF-8"), 256)
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length DIV strongest.period").alias("exponent_milli"),
        sha(F.array_join(F.transform("runs", line), "")).alias("runs_sha256"),
        sha(F.col("collapsed")).alias("collapsed_sha256"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_document_fingerprints, op2_packing, op3_secret_scan, op4_toxicity, op5_exact_dedup, op6_substring_dedup, op7_license_scan,
        op8_bpe_round_trip, op9_minhash_near_dedup, op10_chat_formatting,
        op11_hard_negative_mining, op12_chunked_bpe, op13_periodic_runs)
}
