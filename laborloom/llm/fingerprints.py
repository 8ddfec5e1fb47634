"""Context-triggered piecewise hashes of whole texts, and the likeness of two of them.

A rolling hash of the last WINDOW bytes ends a chunk wherever its low bits are all ones;
each chunk's hash gives one character. The block size is the smallest power of two with
which a text has at most MOST chunks, so nothing is cut off. A fingerprint is
``block:signature:signature at twice the block``. Two fingerprints are compared where they
have a block size in common, by edit distance of those signatures; others have likeness 0.

Null texts are empty (``1::``); two empty signatures are alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborloom.llm import texthash as th
from laborloom.llm.shared import partitions, saved, ship

WINDOW = 7
MOST = 64
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _boundary_levels(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose rolling hash ends in ones, and in how many."""
    rolling = np.zeros(len(data), dtype=np.uint32)
    wide = data.astype(np.uint32) + np.uint32(1)
    for j in range(WINDOW):
        factor = np.uint32((2 * j + 1) * 0x9E3779B1 & 0xFFFFFFFF)
        rolling[j:] += wide[:len(wide) - j] * factor
    rolling ^= rolling >> np.uint32(15)
    rolling *= np.uint32(0x85EBCA6B)
    rolling ^= rolling >> np.uint32(13)
    at = np.flatnonzero(rolling & np.uint32(1))
    above = rolling[at].astype(np.uint64) + np.uint64(1)
    low_bit = above & (~above + np.uint64(1))
    return at, np.log2(low_bit.astype(np.float64)).astype(np.int64)


def _signature(data: np.ndarray, sums: np.ndarray, shift: np.ndarray, cuts: np.ndarray, start: int, end: int) -> str:
    if start == end:
        return ""
    bounds = np.concatenate(([start], cuts[cuts < end - 1] + 1, [end]))
    hashes = (sums[bounds[1:]] - sums[bounds[:-1]]) * shift[bounds[:-1]]
    return ALPHABET[(th.mixed(hashes) >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprints(texts: list[bytes]) -> list[str]:
    """The fingerprint of each text."""
    out = []
    for first, last in th.blocks(texts):
        data, starts, ends = th.joined(texts[first:last], b"\0" * WINDOW)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * th._power(th.BASE, len(data)), out=sums[1:])
        shift = th._power(th.INVERSE, len(data) + 1)
        at, level = _boundary_levels(data)
        low, high = np.searchsorted(at, starts), np.searchsorted(at, ends)
        for start, end, a, b in zip(starts.tolist(), ends.tolist(), low.tolist(), high.tolist(), strict=True):
            cuts, levels = at[a:b], level[a:b]
            more = np.cumsum(np.bincount(levels, minlength=34)[::-1])[::-1]  # cuts at each level or above
            k = max(1, int(np.argmax(more < MOST)))
            pair = [_signature(data, sums, shift, cuts[levels >= j], start, end) for j in (k, k + 1)]
            out.append(f"{1 << k if start < end else 1}:{pair[0]}:{pair[1]}")
    return out


def edit_distances(left: list[str], right: list[str]) -> np.ndarray:
    """Levenshtein distances of pairs of signatures, bit-parallel over the left one's characters."""
    n = len(left)
    mask = np.zeros((n, 128), dtype=np.uint64)
    sizes = np.fromiter(map(len, left), dtype=np.int64, count=n)
    others = np.fromiter(map(len, right), dtype=np.int64, count=n)
    a = np.frombuffer("".join(left).encode(), dtype=np.uint8)
    row = np.repeat(np.arange(n), sizes)
    place = np.arange(len(a)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    np.bitwise_or.at(mask, (row, a), np.uint64(1) << place.astype(np.uint64))
    b = np.zeros((n, max(1, others.max(initial=0))), dtype=np.uint8)
    row = np.repeat(np.arange(n), others)
    b[row, np.arange(others.sum()) - np.repeat(np.cumsum(others) - others, others)] = np.frombuffer(
        "".join(right).encode(), dtype=np.uint8)
    top = np.uint64(1) << np.maximum(sizes - 1, 0).astype(np.uint64)
    one = np.uint64(1)
    up, down, distance = np.full(n, ~np.uint64(0)), np.zeros(n, dtype=np.uint64), sizes.copy()
    for j in range(b.shape[1]):
        equal = mask[np.arange(n), b[:, j]]
        vertical = equal | down
        zero = (((equal & up) + up) ^ up) | equal
        plus, minus = down | ~(zero | up), up & zero
        live = j < others
        distance += live * ((plus & top) != 0)
        distance -= live * ((minus & top) != 0)
        plus, minus = (plus << one) | one, minus << one
        up, down = minus | ~(vertical | plus), plus & vertical
    return np.where(sizes == 0, others, distance)


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """Likeness 0 to 1 of pairs of fingerprints, the best over their common block sizes."""
    best = np.zeros(len(left))
    pairs: list[tuple[int, str, str]] = []
    for i, (a, b) in enumerate(zip(left, right, strict=True)):
        if a == b:
            best[i] = 1.0
            continue
        (p, a1, a2), (q, b1, b2) = a.split(":"), b.split(":")
        p, q = int(p), int(q)
        if p == q:
            pairs += [(i, a1, b1), (i, a2, b2)]
        elif p == 2 * q:
            pairs.append((i, a1, b2))
        elif q == 2 * p:
            pairs.append((i, a2, b1))
    for k in range(0, len(pairs), 4096):
        at, x, y = zip(*pairs[k:k + 4096], strict=True)
        longest = np.maximum(1, np.maximum([len(s) for s in x], [len(s) for s in y]))
        np.maximum.at(best, np.array(at), 1 - edit_distances(list(x), list(y)) / longest)
    return best


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the next text's beginning."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (bucket, guest, doc_id, text): the documents in ranges of doc_id, each range
    followed by a guest, the first document of the next one (the last range: of the first).

    Only ids are looked at to find the ranges; each text then shuffles once. The driver
    holds two numbers a range.
    """
    spark = docs.sparkSession
    count = 2 * partitions(spark)
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))  # null ids come first
    ids = docs.select(key.alias("id"))
    bounds = np.unique(np.array(ids.approxQuantile("id", [i / count for i in range(1, count)], 0.2 / count) or [0.0]))

    @F.pandas_udf("int")
    def bucket(id_: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, id_.to_numpy().astype(np.float64), side="right").astype(np.int32))

    firsts = sorted((r.bucket, r.first) for r in
                    ids.groupBy(bucket("id").alias("bucket")).agg(F.min("id").alias("first")).collect())
    previous = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    # As many rows as there are ranges.
    heads = spark.createDataFrame([(a, b) for a, b in previous.items()] or [(0, 0)], "head long, earlier int")
    rows = docs.select("doc_id", "text", key.alias("id")).withColumn("bucket", bucket("id"))
    own = F.struct(F.col("bucket"), F.lit(0).alias("guest"))
    visit = F.struct(F.col("earlier").alias("bucket"), F.lit(1).alias("guest"))
    return (rows.join(F.broadcast(heads), F.col("id") == F.col("head"), "left")
            .select(F.inline(F.when(F.col("head").isNull(), F.array(own)).otherwise(F.array(own, visit))),
                    "doc_id", "text")
            .repartition(count, "bucket").sortWithinPartitions("bucket", "guest", "doc_id", "text"))


def compare_editions(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses (see SCHEMA).

    Documents follow each other by doc_id, then text; null ids come first.
    """
    ship(docs.sparkSession)

    def measured(rows: list[tuple], prints: dict[str, str]) -> pa.RecordBatch:
        """Rows (doc_id, text, next text)."""
        def of(texts: list[str]) -> list[str]:
            new = list(dict.fromkeys(t for t in texts if t not in prints))
            prints.update(zip(new, fingerprints([t.encode() for t in new]), strict=True))
            return [prints[t] for t in texts]

        texts, after = [r[1] for r in rows], [r[2] for r in rows]
        changed = [edited(a, b) for a, b in zip(texts, after, strict=True)]
        own, following, new = of(texts), of(after), of(changed)
        kept = after[-1] if rows else None
        last = prints.get(kept)
        prints.clear()
        if last is not None:
            prints[kept] = last  # the next batch begins with this text
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array([r[0] for r in rows], pa.int64()),
            "n_chars": pa.array(list(map(len, texts)), pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            "fingerprint": own, "edited_fingerprint": new,
            "near_edited": likeness(own, new), "near_next": likeness(own, following),
        })

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, ready, size, prints = None, [], 0, {}
        for batch in batches:
            for bucket, guest, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = text or ""
                if before is not None and before[0] == bucket:
                    ready.append((before[1], before[2], text))
                    size += len(text)
                    if size > 4 << 20:
                        yield measured(ready, prints)
                        ready, size = [], 0
                before = None if guest else (bucket, doc_id, text)
        if ready:
            yield measured(ready, prints)

    return with_next(docs).mapInArrow(each, SCHEMA)
