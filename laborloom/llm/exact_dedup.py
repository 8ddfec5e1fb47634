"""Exact deduplication by two passes with a Bloom filter, in DataFrame operations only.

Pass one builds a blocked Bloom filter of hashes that occur more than once: every hash has
two positions in one block, and a position's bit is set if two rows share it. Pass two
tests each row. A row whose bits are not both set is alone and passes straight through;
only the others shuffle and are compared by SHA-256.

Texts are equal when identical after deleting space and ``\\x09-\\x0D``; null counts as
empty, and all empty texts are equal. Of equal texts, the row with the most code points
stays, then the smallest doc_id (null last). Other columns do not matter and pass unchanged.

The filter's size is bounded (see ``bloom``). Past that size more rows shuffle than need to,
up to all; the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborloom.llm.bloom import blocks_for, bloom_filter, tested
from laborloom.llm.shared import join_groups, saved, text_or_empty

WHITE = " \t\n\x0b\x0c\r"


def normalised(text: Column | str = "text") -> Column:
    return F.translate(text_or_empty(text), WHITE, "")


def text_sha256(text: Column | str = "text") -> Column:
    return F.sha2(F.encode(normalised(text), "UTF-8"), 256)


def decisions(docs: DataFrame) -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256.

    Rows that repeat a doc_id share its fate. An empty table gives an empty result.
    """
    # Written once, so that both passes read hashes and not texts.
    rows = saved(docs.select(
        "doc_id", F.length(text_or_empty()).alias("chars"), text_sha256().alias("sha")))
    total = rows.count()
    blocks = blocks_for(total)
    marked = tested(rows, "sha", saved(bloom_filter(rows, "sha", blocks, least=2)), blocks)
    alone = marked.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha")
    suspects = marked.where("maybe").select("doc_id", "chars", "sha")
    best = F.struct(-F.col("chars"), F.col("doc_id").isNull(), F.col("doc_id").alias("id"))
    groups = saved(suspects.groupBy("sha").agg(
        F.min(best)["id"].alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    grouped = join_groups(suspects, groups, "sha", "group_size", total).select(*alone.columns)
    return alone.unionByName(grouped).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def survivors(docs: DataFrame) -> DataFrame:
    """The documents that stay, all columns as they came; of rows alike in every way, one.

    Texts of rows that may be repeated shuffle once, reduced to one row a group in each task
    first; all others stay where they are.
    """
    keyed = docs.select(F.struct("*").alias("row"), text_sha256().alias("sha"))
    shas = saved(keyed.select("sha"))
    blocks = blocks_for(shas.count())
    marked = tested(keyed, "sha", saved(bloom_filter(shas, "sha", blocks, least=2)), blocks)
    order = F.struct(-F.length(text_or_empty(F.col("row.text"))), F.col("row.doc_id").isNull(),
                     F.col("row.doc_id"), F.col("row.text"))
    alone = marked.where(~F.col("maybe")).select("row.*")
    best = marked.where("maybe").groupBy("sha").agg(F.min_by("row", order).alias("row"))
    return alone.unionByName(best.select("row.*"))
