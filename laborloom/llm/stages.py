"""Stages of a pipeline over documents; each calls one operator and lets its decisions take effect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborloom.llm import exact_dedup, minhash_dedup, packing, secret_scan, toxicity
from laborloom.llm.queries import VOCABULARY


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.survivors(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share nearly all runs of five words, the one with the smallest id stays."""
    return minhash_dedup.survivors(docs)


def secret_scan_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blanked out; every document stays."""
    return secret_scan.without_secrets(docs, secret_scan.network(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in token windows."""
    return packing.packed(docs, VOCABULARY)
