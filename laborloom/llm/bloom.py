"""A blocked Bloom filter as a DataFrame, built and tested with built-in functions.

A key has two bit positions in one block of 4 KB. The filter has about BITS_PER_ROW bits a
key and at most MAX_BLOCKS blocks (64 MB), the bound of what is broadcast. With more keys it
lets more rows through that it need not, up to all; it never holds back a key it was given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_ROW = 16
BLOCK_BITS = 1 << 15
MAX_BLOCKS = 1 << 14


def blocks_for(rows: int) -> int:
    needed = max(1, rows * BITS_PER_ROW // BLOCK_BITS)
    return min(MAX_BLOCKS, 1 << (needed - 1).bit_length())


def _positions(key: str, blocks: int) -> list[Column]:
    """Block and two bit positions of a key."""
    spread = F.xxhash64(key)
    low = F.lit(BLOCK_BITS - 1).cast("long")
    return [
        spread.bitwiseAND(F.lit(blocks - 1).cast("long")).cast("int").alias("block"),
        F.shiftrightunsigned(spread, 34).bitwiseAND(low).cast("int").alias("bit_a"),
        F.shiftrightunsigned(spread, 49).bitwiseAND(low).cast("int").alias("bit_b"),
    ]


def bloom_filter(keys: DataFrame, key: str, blocks: int, least: int = 1) -> DataFrame:
    """(block, bits): bits of keys that at least ``least`` rows have."""
    set_bits = keys.select(*_positions(key, blocks)).select(
        "block", F.explode(F.array_distinct(F.array("bit_a", "bit_b"))).alias("bit"))
    often = set_bits.groupBy("block", "bit").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= least)
    return often.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bits"))


def _is_set(position: str) -> Column:
    return F.expr(f"((CAST(conv(hex(substring(bits, shiftright({position}, 3) + 1, 1)), 16, 10) AS INT) "
                  f">> ({position} & 7)) & 1) = 1")


def tested(rows: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with ``maybe``: false only for keys that the filter was not given."""
    positions = rows.select("*", *_positions(key, blocks))
    hit = F.coalesce(_is_set("bit_a") & _is_set("bit_b"), F.lit(False))
    # At most MAX_BLOCKS rows of 4 KB.
    return positions.join(F.broadcast(bloom), "block", "left").select(*rows.columns, hit.alias("maybe"))
