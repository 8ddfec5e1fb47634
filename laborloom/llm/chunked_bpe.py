"""Byte-level BPE by ranks, with overlapping chunks for long texts.

A text of more than ``CHUNK + OVERLAP`` characters is cut into chunks that overlap by OVERLAP.
Each is pre-tokenised alone, wherever it lies, from an arbitrary character on. Where a pre-token
begins at the same place in a chunk and in the next one, both go on alike from there: a match
depends on what follows it only, and one that ends before the chunk does is not changed by the
cut. The first such place in an overlap is where the two are stitched. Chunks without one, as
inside a word longer than the overlap, are put together and pre-tokenised again until all have
one. The pieces between stitches are encoded apart and their ids follow each other.

Pre-tokens are merged by the ranks of a file with a base64 token and its rank a line: of the
neighbouring parts whose bytes together are a token, the pair of the smallest rank, the first of
equal ones, until there is none. A pre-token that is a token is taken as it is. Decoding puts
the bytes of the ids together.

The pattern may look ahead by one character, as the public ones do, and not behind. Null texts
are empty and have no ids. Rows that repeat an id, null included, are texts of their own; long
rows alike in id and text are encoded once, with their number in ``copies``. Other columns are
not read. Only long texts shuffle, as chunks; a text's own pre-tokens are the bound of what has
to be in one place.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laborloom.llm.shared import partitions, saved, ship

CHUNK, OVERLAP = 1 << 14, 1 << 8
#: Pre-tokens whose ids a worker keeps; when there are more it begins anew.
KEPT_WORDS = 400_000
#: Pre-tokens of more bytes take their pairs from a heap.
SCANNED = 64
NONE = 1 << 60
#: ``tag`` tells texts of one id apart and is null for texts that are one piece; ``at`` is a piece's first character.
IDS_SCHEMA = "doc_id long, tag binary, copies long, at long, ids binary"
UNIT_SCHEMA = "doc_id long, tag binary, copies long, at long, text string, head array<long>, tail array<long>"
DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Ranks:
    """Tokens by rank, which is also their id, and the ids of pre-tokens met so far."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = [b""] * (1 + max(self.ranks.values()))
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.decimals = list(map(str, range(len(self.tokens))))
        #: Ids of pre-tokens as little-endian unsigned 32-bit numbers.
        self.known: dict[str, bytes] = {}
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        find = self.ranks.get
        pairs = [(left, right, rank) for token, rank in self.ranks.items() for i in range(1, len(token))
                 if (left := find(token[:i])) is not None and (right := find(token[i:])) is not None]
        self._fill(np.array(pairs, dtype=np.int64).reshape(-1, 3))

    def _fill(self, pairs: np.ndarray) -> None:
        """A table of ids of neighbours, by hash, with free slots behind taken ones."""
        bits = max(10, int(4 * len(pairs)).bit_length())
        self.shift, self.slots = np.uint64(64 - bits), 1 << bits
        self.keys, self.values = np.full(self.slots, -1, dtype=np.int64), np.full(self.slots, NONE, dtype=np.int64)
        keys, values = pairs[:, 0] * len(self.tokens) + pairs[:, 1], pairs[:, 2]
        place = self._slot(keys)
        while len(keys):
            free = self.keys[place] < 0
            self.keys[place[free]] = keys[free]  # of those that want one slot the last gets it
            won = self.keys[place] == keys
            self.values[place[won]] = values[won]
            keys, values, place = keys[~won], values[~won], (place[~won] + 1) % self.slots

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, NONE where they make no token; a negative id stands for nothing."""
        keys = np.where((left < 0) | (right < 0), -2, left * len(self.tokens) + right)
        place = self._slot(keys)
        out = np.full(len(keys), NONE, dtype=np.int64)
        open_ = np.arange(len(keys))
        while len(open_):
            there = self.keys[place]
            same = there == keys
            out[open_[same]] = self.values[place[same]]
            on = ~same & (there >= 0)
            open_, keys, place = open_[on], keys[on], (place[on] + 1) % self.slots
        return out

    def learn(self, words: set[str]) -> None:
        """Merge the words that are not known yet, those of one length together."""
        new = words.difference(self.known)
        if len(self.known) + len(new) > KEPT_WORDS:
            self.known.clear()
            new = words
        by_length: dict[int, list[str]] = {}
        for word in new:
            by_length.setdefault(len(word.encode()), []).append(word)
        for length, same in by_length.items():
            data = [word.encode() for word in same]
            if length > SCANNED:
                self.known.update((w, np.array(self.merge(d), dtype="<u4").tobytes()) for w, d in zip(same, data, strict=True))
                continue
            whole = [self.ranks.get(d) for d in data]
            self.known.update((w, rank.to_bytes(4, "little")) for w, rank in zip(same, whole, strict=True) if rank is not None)
            rest = [i for i, rank in enumerate(whole) if rank is None]
            for first in range(0, len(rest), 1 << 14):
                some = rest[first:first + (1 << 14)]
                parts = self._merge_together(b"".join(data[i] for i in some), length)
                self.known.update(zip((same[i] for i in some), parts, strict=True))

    def _merge_together(self, data: bytes, length: int) -> list[bytes]:
        """Ids of words of one length, a merge of each at a time; rows hold their parts, then -1."""
        parts = self.of_byte[np.frombuffer(data, dtype=np.uint8)].reshape(-1, length)
        rows = np.arange(len(parts))
        out: list[bytes] = [b""] * len(parts)
        ranks = self._rank(parts[:, :-1].ravel(), parts[:, 1:].ravel()).reshape(len(parts), length - 1)
        while len(rows):
            at = ranks.argmin(axis=1)
            best = np.take_along_axis(ranks, at[:, None], axis=1)[:, 0]
            done = best == NONE
            if done.any():
                finished, counts = parts[done], (parts[done] >= 0).sum(axis=1).tolist()
                for row, ids, n in zip(rows[done].tolist(), finished.astype("<u4"), counts, strict=True):
                    out[row] = ids[:n].tobytes()
                parts, ranks, rows, at, best = parts[~done], ranks[~done], rows[~done], at[~done], best[~done]
                if not len(rows):
                    break
            # The part behind the merged one goes and the rest moves up.
            every = np.arange(len(rows))
            parts[every, at] = best
            columns = np.arange(parts.shape[1] - 1)
            parts = np.take_along_axis(parts, columns + (columns > at[:, None]), axis=1)
            ranks = np.take_along_axis(ranks, columns[:-1] + (columns[:-1] >= at[:, None]), axis=1)
            padded = np.pad(parts, ((0, 0), (1, 1)), constant_values=-1)
            if ranks.shape[1]:
                for left in (at - 1, at):
                    inside = (left >= 0) & (left < ranks.shape[1])
                    i, j = every[inside], left[inside]
                    ranks[i, j] = self._rank(padded[i, j + 1], padded[i, j + 2])
            else:
                ranks = np.full((len(rows), 1), NONE, dtype=np.int64)
        return out

    def encode(self, texts: list[list[str]]) -> list[bytes]:
        """Ids of texts given as pre-tokens."""
        self.learn(set().union(*texts))
        return [b"".join(map(self.known.__getitem__, words)) for words in texts]

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token of any length, with a heap of (rank, place) and linked parts."""
        if word in self.ranks:
            return [self.ranks[word]]
        find, size = self.ranks.get, len(word)
        after, before = list(range(1, size + 2)), list(range(-1, size))
        heap = [(rank, i, i + 2) for i in range(size - 1) if (rank := find(word[i:i + 2])) is not None]
        heapq.heapify(heap)
        gone = bytearray(size + 1)
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = after[i]
            if gone[i] or middle >= size or after[middle] != end:
                continue  # one of its parts has been merged since
            gone[middle] = 1
            after[i] = end
            if end <= size:
                before[end] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < size:
                    right = after[after[left]]
                    if (rank := find(word[left:right])) is not None:
                        heapq.heappush(heap, (rank, left, right))
        ids, i = [], 0
        while i < size:
            ids.append(self.ranks[word[i:after[i]]])
            i = after[i]
        return ids

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def ranks_of(path: str) -> Ranks:
    """One table for each worker process."""
    return Ranks(path)


def _cut(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """The chunks of long texts, dealt out anew; those of rows alike in id and text are one row."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                tag = hashlib.sha256(text.encode()).digest()
                places = range(0, max(1, len(text) - overlap), chunk)
                for some in (places[i:i + 64] for i in range(0, len(places), 64)):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([doc_id] * len(some), pa.int64()), pa.array([tag] * len(some), pa.binary()),
                        pa.array(some, pa.int64()), pa.array([text[i:i + chunk + overlap] for i in some], pa.string()),
                    ], ["doc_id", "tag", "at", "text"])

    cut = texts.mapInArrow(each, "doc_id long, tag binary, at long, text string")
    return cut.groupBy("doc_id", "tag", "at").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))


def _scanned(chunks: DataFrame, pattern: str, overlap: int) -> DataFrame:
    """Chunks with the places of the text where pre-tokens begin in their first and last ``overlap`` characters."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = regex.compile(pattern).finditer
        for batch in batches:
            heads, tails = [], []
            for at, text in zip(*(batch.column(c).to_pylist() for c in ("at", "text")), strict=True):
                places = np.array([m.start() for m in begin(text)], dtype=np.int64)
                heads.append((places[places < overlap] + at).tolist())
                tails.append((places[places >= len(text) - overlap] + at).tolist())
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "tag", "copies", "at", "text")),
                 pa.array(heads, lists), pa.array(tails, lists)],
                ["doc_id", "tag", "copies", "at", "text", "head", "tail"])

    return chunks.select("doc_id", "tag", "copies", "at", "text").mapInArrow(each, UNIT_SCHEMA)


def pieces(texts: DataFrame, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, tag, copies, at, text): long texts cut where pre-tokens begin."""
    units = saved(_scanned(_cut(texts, chunk, overlap), pattern, overlap))
    order = W.partitionBy("doc_id", "tag").orderBy("at")
    while True:
        stitch = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
        stitched = saved(units.withColumns({"stitch": stitch, "last": F.lead("at").over(order).isNull()}))
        if stitched.where("NOT last AND stitch IS NULL").isEmpty():
            break
        # A chunk begins a group unless the one before it found no stitch.
        begins = F.lag(F.col("stitch").isNotNull(), 1, True).over(order)
        grouped = stitched.withColumn("begins", begins).withColumn(
            "part", F.sum(F.col("begins").cast("long")).over(order))
        joined = grouped.groupBy("doc_id", "tag", "copies", "part").agg(
            F.min("at").alias("at"), F.sort_array(F.collect_list(F.struct("at", "text", "head", "tail"))).alias("chunks"))
        alone = joined.where("size(chunks) = 1").select("doc_id", "tag", "copies", "at", F.inline("chunks").alias(
            "_at", "text", "head", "tail")).drop("_at")
        # What two neighbours have in common is the second's first ``overlap`` characters.
        whole = F.concat(F.col("chunks")[0]["text"], F.array_join(F.transform(
            F.slice("chunks", 2, F.size("chunks")), lambda c: F.substring(
                c["text"], F.lit(overlap + 1), F.length(c["text"]))), ""))
        again = _scanned(joined.where("size(chunks) > 1").withColumn("text", whole), pattern, overlap)
        units = saved(alone.unionByName(again))
    first = F.coalesce(F.lag("stitch").over(order), F.col("at"))
    end = F.coalesce(F.col("stitch"), F.col("at") + F.length("text"))
    return stitched.withColumns({"first": first, "end": end}).select(
        "doc_id", "tag", "copies", F.col("first").alias("at"),
        F.substring("text", (F.col("first") - F.col("at") + 1).cast("int"),
                    (F.col("end") - F.col("first")).cast("int")).alias("text"))


def _parts(docs: DataFrame, pattern: str, chunk: int, overlap: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, tag, copies, at, text) of the short texts, whole, and of the pieces of the long ones."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    long = F.length("text") > chunk + overlap
    short = texts.where(~long).select(
        "doc_id", F.lit(None).cast("binary").alias("tag"), F.lit(1).cast("long").alias("copies"),
        F.lit(0).cast("long").alias("at"), "text")
    return short, pieces(texts.where(long), pattern, chunk, overlap)


def _encoded(parts: DataFrame, path: str, pattern: str) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, encode = regex.compile(pattern).findall, ranks_of(path).encode
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                ids = encode([words(t) for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "tag", "copies", "at")), pa.array(ids, pa.binary())],
                    ["doc_id", "tag", "copies", "at", "ids"])

    return parts.mapInArrow(each, IDS_SCHEMA)


def encoded(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Ids of every whole text (see IDS_SCHEMA): a row for a short text, one for each piece of a long one."""
    short, long = _parts(docs, pattern, chunk, overlap)
    return _encoded(short, path, pattern).unionByName(_encoded(long, path, pattern))


def decoded(ids: DataFrame, path: str) -> DataFrame:
    """``ids`` with ``decoded``, the bytes that each row's ids stand for."""
    ship(ids.sparkSession)
    names = ["doc_id", "tag", "copies", "at", "ids"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            back = list(map(ranks_of(path).decode, batch.column("ids").to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(back, pa.binary())], [*names, "decoded"])

    return ids.select(*names).mapInArrow(each, IDS_SCHEMA + ", decoded binary")


def digests(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Numbers of ids of every whole text, hashes of the ids and of the bytes they decode to (see DIGEST_SCHEMA).

    The pieces of a text come to one task in their order and pass through it one by one.
    """
    short, long = _parts(docs, pattern, chunk, overlap)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(path)
        key, open_ = None, None  # of the text whose pieces are coming in
        for batch in batches:
            out: list[tuple] = []
            for doc_id, tag, copies, piece in zip(
                    *(batch.column(c).to_pylist() for c in ("doc_id", "tag", "copies", "ids")), strict=True):
                numbers = np.frombuffer(piece, dtype="<u4").tolist()
                if tag is None or (doc_id, tag) != key:
                    out += [open_] if open_ else []
                    key, open_ = (doc_id, tag), [doc_id, copies, 0, hashlib.sha256(), hashlib.sha256()]
                line = " ".join(map(ranks.decimals.__getitem__, numbers))
                open_[3].update((" " + line if open_[2] and numbers else line).encode())
                open_[4].update(b"".join(map(ranks.tokens.__getitem__, numbers)))
                open_[2] += len(numbers)
            yield rows_of(out)
        yield rows_of([open_] if open_ else [])

    def rows_of(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.int64()),
            pa.array([r[3].hexdigest() for r in out], pa.string()), pa.array([r[4].hexdigest() for r in out], pa.string()),
            pa.array([r[1] for r in out], pa.int64()),
        ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "copies"])

    schema = DIGEST_SCHEMA + ", copies long"
    whole = _encoded(short, path, pattern).mapInArrow(each, schema)
    in_order = _encoded(long, path, pattern).repartition(
        partitions(docs.sparkSession), "doc_id", "tag").sortWithinPartitions("doc_id", "tag", "at")
    parted = in_order.mapInArrow(each, schema).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    return whole.select(*columns).unionByName(parted.select(*columns))
