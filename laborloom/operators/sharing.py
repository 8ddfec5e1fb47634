from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shared(rows: DataFrame) -> DataFrame:
    """The same rows behind a generator, for a frame that several branches filter differently.

    Predicates and column pruning stop at the generator, so every branch keeps an identical
    plan below it and Spark computes the shuffle feeding it once (``ReusedExchange``) instead
    of scanning the input per branch. Worth it after an aggregation, where rows are few.
    """
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


#: Copies of a row that one task writes out at a time.
COPIES_IN_BLOCK = 4096


def repeated(rows: DataFrame, copies: str) -> DataFrame:
    """Each row as often as its ``copies`` say, without that column.

    Copies are written out in blocks that are first spread over tasks, so that neither an array
    nor a task grows with a heavily repeated row.
    """
    columns = [c for c in rows.columns if c != copies]
    last = F.floor((F.col(copies) - 1) / COPIES_IN_BLOCK)
    blocks = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    spread = blocks.repartition(*columns, "block")
    rest = F.least(F.lit(COPIES_IN_BLOCK).cast("long"), F.col(copies) - F.col("block") * COPIES_IN_BLOCK)
    return spread.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), rest)).alias("copy")).drop("copy")
