"""Order-preserving packing of documents into token windows.

The documents of a partition form one stream of tokens in their order, each followed by an
end id. Windows of at most ``length`` tokens are cut from it by dynamic programming: the
cost of a window is its padding plus a penalty for the cut behind it, which is 0 between
documents, SENTENCE_PENALTY after a sentence and INSIDE_PENALTY elsewhere. As the padding
of a window is the difference of its two ends, the best previous cut is the minimum of
``cost + position`` over a sliding range, which a monotone queue gives in constant time.

What remains at the end of a partition is cut into powers of two, which need no padding.
No row shuffles and memory is bounded: the stream is solved in blocks of BLOCK_TOKENS and
the last, open window moves on to the next block. Null texts are empty: one end id.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from laborloom.llm.bpe import PATTERN, Encoder
from laborloom.llm.shared import ship

LENGTH = 1024
END_ID = 0
SENTENCE_PENALTY = 2
INSIDE_PENALTY = 16
BLOCK_TOKENS = 1 << 20
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


class LibraryEncoder(Encoder):
    """The encoder with a library's merges, which takes a text without special tokens whole."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.library = tiktoken.Encoding(
            "own", pat_str=PATTERN, mergeable_ranks=self.vocabulary.ids, special_tokens={})

    def plain(self, text: str) -> bytes:
        try:
            return self.library.encode_to_numpy(text).astype("<u4").tobytes()
        except ValueError:  # the library's pattern gives up on very long runs of white space
            return self._chunk(text)


@lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    """One encoder for each worker process."""
    return LibraryEncoder(path)


def sentence_ends(path: str) -> np.ndarray:
    """For each id, whether its token ends a sentence."""
    tokens = library_encoder(path).vocabulary.tokens
    return np.array([t.endswith((b".", b"!", b"?", b"\n")) for t in tokens])


def best_cuts(positions: np.ndarray, penalties: np.ndarray, length: int) -> list[int]:
    """Cuts of least cost among sorted ``positions``, of which no two neighbours are more than
    ``length`` apart. The stream starts at 0; the last cut leaves less than a window behind."""
    places, extra = positions.tolist(), penalties.tolist()
    cost, back = [0] * len(places), [-1] * len(places)
    queue: deque[tuple[int, int, int]] = deque([(0, 0, -1)])  # cost + position, position, index
    for j, place in enumerate(places):
        while queue[0][1] < place - length:
            queue.popleft()
        least, _, back[j] = queue[0]
        cost[j] = least + length - place + extra[j]
        value = cost[j] + place
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, place, j))
    _, _, j = queue[0]
    cuts = []
    while j >= 0:
        cuts.append(places[j])
        j = back[j]
    return cuts[::-1]


def candidates(ends: np.ndarray, sentences: np.ndarray, total: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may end and the penalty there: behind documents and sentences,
    and in steps inside sentences, so that a whole number of windows fits a long one too."""
    penalty = np.full(total + 1, -1, dtype=np.int64)
    penalty[np.arange(0, total + 1, max(1, length // 64))] = INSIDE_PENALTY
    penalty[sentences + 1] = SENTENCE_PENALTY
    penalty[ends] = 0
    penalty[0] = -1
    at = np.flatnonzero(penalty >= 0)
    return at, penalty[at]


class Stream:
    """The open end of a partition's tokens and the documents they belong to."""

    def __init__(self, ends_sentence: np.ndarray, length: int, first_sequence: int) -> None:
        self.ends_sentence, self.length, self.sequence = ends_sentence, length, first_sequence
        self.ids: list[bytes] = []
        self.docs: list[tuple] = []  # id, tokens in front of this part, tokens of this part, tokens of the document
        self.size = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        ids += END_ID.to_bytes(4, "little")
        count = len(ids) // 4
        self.ids.append(ids)
        self.docs.append((doc_id, 0, count, count))
        self.size += count

    def cut(self, last: bool) -> pa.RecordBatch:
        """Windows of all that was added, or all but an open end."""
        data = b"".join(self.ids)
        lengths = np.array([d[2] for d in self.docs], dtype=np.int64)
        ends = np.cumsum(lengths)
        tokens = np.frombuffer(data, dtype="<u4")
        at, penalties = candidates(ends, np.flatnonzero(self.ends_sentence[tokens]), self.size, self.length)
        cuts = best_cuts(at, penalties, self.length) if self.size else []
        while last and cuts and self.size - cuts[-1] == 0 and len(cuts) > 1 and cuts[-1] - cuts[-2] < self.length:
            cuts.pop()  # the open end is at most a window
        if last:
            place = cuts[-1] if cuts else 0
            for bit in range(self.length.bit_length() - 1, -1, -1):
                while self.size - place >= 1 << bit:
                    place += 1 << bit
                    cuts.append(place)
        done = cuts[-1] if cuts else 0
        windows = np.array([0, *cuts], dtype=np.int64)
        begins = ends - lengths
        # Pieces lie between neighbouring cuts of either kind.
        edges = np.unique(np.concatenate([windows, ends[ends <= done], begins[begins < done]]))
        left, right = edges[:-1], edges[1:]
        doc = np.searchsorted(ends, left, side="right")
        window = np.searchsorted(windows, left, side="right") - 1
        before = np.array([d[1] for d in self.docs], dtype=np.int64)
        whole = np.array([d[3] for d in self.docs], dtype=np.int64)
        view = memoryview(data)
        batch = pa.RecordBatch.from_arrays([
            pa.array([self.docs[i][0] for i in doc.tolist()], pa.int64()),
            pa.array(before[doc] + left - begins[doc]),
            pa.array(right - left),
            pa.array([zlib.crc32(view[4 * a:4 * b]) for a, b in zip(left.tolist(), right.tolist(), strict=True)],
                     pa.int64()),
            pa.array(whole[doc]),
            pa.array(self.sequence + window),
            pa.array(left - windows[window]),
        ], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        self.sequence += len(cuts)
        kept = [(d[0], d[1] + max(0, done - b), e - max(done, b), d[3])
                for d, b, e in zip(self.docs, begins.tolist(), ends.tolist(), strict=True) if e > done]
        self.ids, self.docs, self.size = [data[4 * done:]], kept, self.size - done
        return batch


def packed(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """One row per piece of a document in a window (see SCHEMA); ``length`` is a power of two.

    Every id lies in exactly one piece. ``sequence_id`` numbers windows inside a partition's
    range of numbers, ``offset`` is the place in the window.
    """
    ship(docs.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(path).encode
        stream = Stream(sentence_ends(path), length, TaskContext.get().partitionId() << 40)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for doc_id, text in zip(ids, texts, strict=True):
                stream.add(doc_id, encode(text.as_py() or ""))
                if stream.size >= BLOCK_TOKENS:
                    yield stream.cut(last=False)
        yield stream.cut(last=True)

    return docs.select("doc_id", "text").mapInArrow(each, SCHEMA)
