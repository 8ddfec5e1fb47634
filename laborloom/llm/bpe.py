"""Byte-pair encoding and decoding with a public vocabulary.

A text is cut into pre-tokens; each short one is merged in a contiguous array that holds the
remaining part boundaries with the rank of the pair that starts at each. The array is
scanned for the smallest rank, that boundary deleted and the ranks beside it refreshed,
until no pair has a rank. Frequent words are kept with their ids in bounded tables.

The vocabulary file is the JSON of a byte-level BPE; its path is a parameter. Null texts are
empty and have no ids.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from laborloom.llm.shared import ship

#: Fixed value: the pre-token pattern of this public vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEPT_WORDS = 300_000
LONGEST_KEPT = 64
NONE = 1 << 60
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: White space next to a space, where a text may not be cut at every space.
UNEVEN = regex.compile(r"\s\s|^\s|\s$")
#: A run of white space that is not put together from its spaces.
LONG_GAP = regex.compile(r"\s{1000}")


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Token bytes and merge ranks of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        symbols = byte_symbols()
        as_bytes = lambda token: bytes(symbols[c] for c in token)
        self.ids = {as_bytes(token): i for token, i in described["model"]["vocab"].items()}
        merges = (m if isinstance(m, list) else m.split(" ") for m in described["model"]["merges"])
        pairs = [(as_bytes(a), as_bytes(b)) for a, b in merges]
        #: Rank by pair of ids, and the merged id by rank.
        self.ranks = {(self.ids[a], self.ids[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [self.ids[a + b] for a, b in pairs]
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        size = 1 + max([*self.ids.values(), *self.special.values()])
        self.tokens = [b""] * size
        for token, i in self.ids.items():
            self.tokens[i] = token
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        self.cut = regex.compile(PATTERN)
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        parts = [self.ids[word[i:i + 1]] for i in range(len(word))]
        if len(parts) > 512:
            return self._merge_long(parts)
        find, merged = self.ranks.get, self.merged
        ranks = [find(pair, NONE) for pair in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == NONE:
                break
            i = ranks.index(best)
            parts[i] = merged[best]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = find((parts[i - 1], parts[i]), NONE)
            if i < len(ranks):
                ranks[i] = find((parts[i], parts[i + 1]), NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same for long pre-tokens, in linear passes: all places of the smallest rank at once."""
        size = len(self.tokens)
        ids = np.array(parts, dtype=np.int64)
        known = np.array([a * size + b for a, b in self.ranks], dtype=np.int64)
        order = np.argsort(known)
        known = known[order]
        values = np.array(list(self.ranks.values()), dtype=np.int64)[order]
        merged = np.array(self.merged, dtype=np.int64)
        while len(ids) > 1:
            pairs = ids[:-1] * size + ids[1:]
            at = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
            ranks = np.where(known[at] == pairs, values[at], NONE)
            best = ranks.min()
            if best == NONE:
                break
            places = np.flatnonzero(ranks == best)
            # Of overlapping places, as in aaa, every second one from the left counts.
            first = np.maximum.accumulate(np.where(np.diff(places, prepend=-2) > 1, places, 0))
            places = places[(places - first) % 2 == 0]
            ids[places] = merged[best]
            ids = np.delete(ids, places + 1)
        return ids.tolist()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, with tables of frequent words."""

    def __init__(self, path: str) -> None:
        self.vocabulary = vocabulary(path)
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            ids = np.array(self.vocabulary.merge(word.encode()), dtype="<u4").tobytes()
            if len(word) <= LONGEST_KEPT:
                if len(self.words) >= KEPT_WORDS:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def _chunk(self, chunk: str) -> bytes:
        ids = self.chunks.get(chunk)
        if ids is None:
            ids = b"".join(map(self._word, self.vocabulary.cut.findall(chunk)))
            if len(chunk) <= LONGEST_KEPT:
                if len(self.chunks) >= KEPT_WORDS:
                    self.chunks.clear()
                self.chunks[chunk] = ids
        return ids

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        uneven = UNEVEN.search(text)
        if uneven and LONG_GAP.search(text):
            return self._chunk(text)
        # A space between two other characters always begins a pre-token.
        first, *rest = text.split(" ")
        parts = [first, *[" " + part for part in rest]]
        if uneven:
            whole, parts = parts, []
            for part in whole:
                if parts and (part == " " or part[1:2].isspace() or not parts[-1] or parts[-1][-1:].isspace()):
                    parts[-1] += part
                else:
                    parts.append(part)
        find = self.chunks.get
        return b"".join([find(p) or self._chunk(p) for p in parts])

    def encode(self, text: str) -> bytes:
        cut = self.vocabulary.special_cut
        if cut is None or not any(s in text for s in self.vocabulary.special):
            return self.plain(text)
        special = self.vocabulary.special
        return b"".join(np.uint32(special[part]).astype("<u4").tobytes() if part in special else self.plain(part)
                        for part in cut.split(text))

    def decode(self, ids: bytes) -> str:
        tokens = self.vocabulary.tokens
        return b"".join(map(tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process, so that its tables serve all tasks."""
    return Encoder(path)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of every whole text, as little-endian unsigned 32-bit numbers in a binary."""
    ship(docs.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                ids = [encode(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(each, "doc_id long, ids binary")


def digests(ids: DataFrame, path: str) -> DataFrame:
    """Counts and hashes of ids and of the texts they decode to (see SCHEMA)."""
    ship(ids.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        names = list(map(str, range(len(coder.vocabulary.tokens))))
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            rows = batch.column("ids").to_pylist()
            numbers = [np.frombuffer(r, dtype="<u4").tolist() for r in rows]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([len(r) // 4 for r in rows], pa.int64()),
                pa.array([sha(",".join(map(names.__getitem__, n)).encode()) for n in numbers], pa.string()),
                pa.array([sha(coder.decode(r).encode()) for r in rows], pa.string()),
            ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return ids.mapInArrow(each, SCHEMA)
