"""A training corpus from ``documents``: each stage works on all that the one before kept.

Toxic documents go, then exact copies, then near copies; secrets are blanked out and what is
left is packed into token windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from laborloom.llm import stages
from laborloom.llm.shared import documents, saved

STAGES = [
    ("toxicity", stages.toxicity_stage),
    ("exact_dedup", stages.exact_dedup_stage),
    ("minhash_near_dedup", stages.near_dedup_stage),
    ("secret_scan", stages.secret_scan_stage),
    ("packing", stages.packing_stage),
]
#: SQL can express neither the classifier nor the tokenizer; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    rows = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        rows = saved(stage(spark, rows, sf_dir))
    return STAGES[-1][1](spark, rows, sf_dir)
