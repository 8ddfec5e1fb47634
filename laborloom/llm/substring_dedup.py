"""Substring deduplication by level-wise doubling of repeated word windows.

Level one looks at windows of ``window / 4`` words. Windows that repeat in another document,
and they alone, are extended to twice their length, and so on until the full ``window`` is
reached or none is left. In each full window one part of the level's length stands for it: at
first the one with the least hash, then that part extended to its right, or, where the full
window ends, to its left. Equal full windows choose equal parts in every text, so none is
lost, and only about a fifth of all windows are looked at on level one.

Words are runs without space or ``\\x09-\\x0D``. A word is removed if a window over it also
starts in a document with a smaller doc_id, judged on the input. Null texts have no words;
a null doc_id counts as the largest; rows that share a doc_id do not remove from each other,
and each is judged by its own text. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborloom.llm import texthash as th
from laborloom.llm.bloom import blocks_for, bloom_filter, tested
from laborloom.llm.shared import saved, ship, text_or_empty, with_bounds

WINDOW = 13
LAST = (1 << 63) - 1
KEPT_SCHEMA = "doc_id long, n_words long, n_removed long, kept string"


def first_level(window: int) -> int:
    return max(1, -(-window // 4))


def lengths(window: int) -> list[int]:
    """Lengths of the levels, each twice the one before and the last ``window`` itself."""
    levels = [first_level(window)]
    while levels[-1] < window:
        levels.append(min(2 * levels[-1], window))
    return levels


class Parts:
    """The full windows of some texts, by the place of their first word in all of them."""

    def __init__(self, texts: list[bytes], window: int):
        self.words, bounds = th.word_hashes(texts)
        self.window, self.firsts = window, bounds
        self.owners = np.repeat(np.arange(len(texts)), np.diff(bounds))
        full = max(0, len(self.words) - window + 1)
        hashes = th.window_hashes(self.words, first_level(window))
        least, offsets = hashes[:full].copy(), np.zeros(full, dtype=np.int32)
        for j in range(1, window - first_level(window) + 1):
            less = hashes[j:j + full] < least
            np.copyto(least, hashes[j:j + full], where=less)
            offsets[less] = j
        self.starts = np.flatnonzero(self.owners[:full] == self.owners[window - 1:])
        self.offsets = offsets[self.starts]

    def of_length(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the part of ``length`` words that stands for each full window, and its text."""
        places = self.starts + np.minimum(self.offsets, self.window - length)
        return th.window_hashes(self.words, length)[places], self.owners[self.starts]

    def keep(self, chosen: np.ndarray) -> None:
        self.starts, self.offsets = self.starts[chosen], self.offsets[chosen]


def _keyed(hashes: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """One number for a hash in a text."""
    return hashes ^ th.mixed(owners.astype(np.uint64) + np.uint64(1))


def level_windows(docs: DataFrame, window: int, level: int) -> DataFrame:
    """(hash, doc, tag, place) of a level's windows: on the last level all of them, with the place
    of the first word; on the others distinct ones of each text, with place 0.

    From the second level on ``docs`` has the hashes that repeat on the level before, and only
    full windows whose part of that length is among them go on.
    """
    sizes = lengths(window)
    length, last = sizes[level], level == len(sizes) - 1
    columns = ["doc", "tag", "text", *(["repeated"] if level else [])]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "tag"))
            texts = th.texts_of(batch)
            for first, end in th.blocks(texts):
                parts = Parts(texts[first:end], window)
                if level and len(parts.starts):
                    known = batch.column("repeated").slice(first, end - first)
                    sets = known.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                    sizes_of = known.value_lengths().to_numpy(zero_copy_only=False)
                    before = _keyed(*parts.of_length(sizes[level - 1]))
                    parts.keep(np.isin(before, _keyed(sets, np.repeat(np.arange(end - first), sizes_of))))
                if not len(parts.starts):
                    continue
                hashes, owners = parts.of_length(length)
                places = parts.starts - parts.firsts[owners]
                if not last:
                    order = np.unique(_keyed(hashes, owners), return_index=True)[1]
                    hashes, owners, places = hashes[order], owners[order], np.zeros(len(order), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(hashes.view(np.int64)), pa.array(ids[first + owners], pa.int64()),
                    pa.array(tags[first + owners], pa.int64()), pa.array(places.astype(np.int32)),
                ], ["hash", "doc", "tag", "place"])

    return docs.select(*columns).mapInArrow(each, "hash long, doc long, tag long, place int")


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, tag, places): where windows start that also start in a document with a smaller id.

    ``docs`` has doc, tag and text; doc and tag tell a row.
    """
    ship(docs.sparkSession)
    candidates, final = docs, len(lengths(window)) - 1
    for level in range(final):
        windows = saved(level_windows(candidates, window, level).drop("place"))
        # A text's own windows and no more, however many rows share its id.
        repeated = saved(with_bounds(windows, "hash", "doc").where("lo < hi").groupBy("doc", "tag").agg(
            F.collect_set("hash").alias("repeated")))
        blocks = blocks_for(repeated.count())
        maybe = tested(docs, "tag", saved(bloom_filter(repeated, "tag", blocks)), blocks)
        candidates = maybe.where("maybe").select("doc", "tag", "text").join(repeated, ["doc", "tag"])
    windows = saved(level_windows(candidates, window, final))
    later = with_bounds(windows, "hash", "doc").where("doc > lo")
    return saved(later.groupBy("doc", "tag").agg(F.sort_array(F.collect_set("place")).alias("places")))


def deduplicated(docs: DataFrame, window: int = WINDOW, digest: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and kept, the words that stay joined by
    one space, or with ``digest`` the SHA-256 of that. Texts without repeats do not shuffle."""
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("doc"),
                       F.xxhash64("text").alias("tag"), text_or_empty().alias("text"))
    places = repeated_windows(rows.select("doc", "tag", "text"), window)
    blocks = blocks_for(places.count())
    marked = tested(rows, "tag", saved(bloom_filter(places, "tag", blocks)), blocks)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, gone, texts = [], [], []
            for text, found in zip(th.texts_of(batch), batch.column("places"), strict=True):
                words = text.split()  # of bytes: at exactly the white space named above
                counts.append(len(words))
                if found.is_valid:
                    starts = np.asarray(found.values, dtype=np.int64)
                    step = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(step, starts, 1)
                    np.add.at(step, starts + window, -1)
                    covered = np.cumsum(step)[:-1] > 0
                    words = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
                gone.append(counts[-1] - len(words))
                kept = b" ".join(words)
                texts.append(hashlib.sha256(kept).hexdigest() if digest else kept.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(texts, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    columns = ["doc_id", "text", "places"]
    untouched = marked.where(~F.col("maybe")).withColumn("places", F.lit(None).cast("array<int>")).select(*columns)
    touched = marked.where("maybe").drop("maybe").join(places, ["doc", "tag"], "left").select(*columns)
    return untouched.unionByName(touched).mapInArrow(each, KEPT_SCHEMA)
