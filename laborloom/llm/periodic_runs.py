"""Periodic runs of words, caught online in dyadic blocks.

A run is a stretch of consecutive words with smallest period q that is at least
``max(LEAST_WORDS, TIMES * q)`` words long and that no neighbouring word extends keeping q.

Words are appended in order. Level k looks after periods in (S, 2S], S = 2**(k - 1), and keeps
catchers: hashes of blocks of 2S words that begin at multiples of S, each put together from two
completed blocks of the level below. An appended word completes one block per level, which can be
a copy, by such a period, of only one catcher's block, so it is compared with that one. A match is
a square. Its suffix comparisons go back from it at once and forward as far as words are there,
going on when more are appended; squares inside a stretch already held merge into it. A stretch
of four periods always holds a catcher's block and its copy one period on: of the places where both
fit there are 3q - 2S + 1, at least S. A stretch inside one of a smaller period is that one's.

Words are numbered exactly and squares are checked on the numbers, so hashes decide nothing
alone. A text takes some log2(words) steps and numbers a word; nothing shuffles.

Words are runs without space or ``\\x09-\\x0D``. Null and empty texts have no words and no runs.
Rows that repeat an id, null included, are treated each for itself; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from laborloom.llm.shared import ship
from laborloom.llm.texthash import mixed, texts_of

LEAST_WORDS, TIMES = 6, 4
#: Words appended at once.
STEP = 1 << 14
RUN = "struct<start: long, length: long, period: long>"
SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>, strongest {RUN}, collapsed string"
Run = tuple[int, int, int]
_LEFT, _RIGHT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements are equal; the work follows the answer, not the arrays."""
    done, step, size = 0, 64, min(len(a), len(b))
    while done < size:
        stop = min(size, done + step)
        differ = np.flatnonzero(a[done:stop] != b[done:stop])
        if len(differ):
            return done + int(differ[0])
        done, step = stop, 2 * step
    return size


class Catchers:
    """The runs of a growing sequence of numbered words."""

    def __init__(self) -> None:
        self.words = np.zeros(0, dtype=np.int64)
        #: For each level the hashes of its blocks by first word.
        self.blocks: list[np.ndarray] = []
        #: Start by period of the stretches that reach the last word; (start, end, period) of those
        #: that do not: the ones of a run's length, and all that end in the last appended words.
        self.open: dict[int, int] = {}
        self.closed: list[tuple[int, int, int]] = []
        self.recent: list[tuple[int, int, int]] = []

    def append(self, words: np.ndarray) -> None:
        before = len(self.words)
        self.words = np.concatenate([self.words, words])
        n = len(self.words)
        self.recent = []
        for period, start in list(self.open.items()):
            self._advance(period, start, before)
        level = 0
        # Level k has the periods above (1 << k) >> 1; the smallest of them must fit TIMES times.
        while level == 0 or TIMES * ((1 << level - 1) + 1) <= n:
            first = max(0, before - (1 << level) + 1)
            if level == len(self.blocks):  # a level that was of no use so far looks at all words
                self.blocks.append(np.zeros(0, dtype=np.uint64))
                first = 0
            self._complete(level)
            self._catch(level, first, n - (1 << level) + 1)
            level += 1

    def _complete(self, level: int) -> None:
        """Hashes of the level's blocks that the appended words have completed."""
        have = len(self.blocks[level])
        if level == 0:
            new = mixed(self.words[have:].astype(np.uint64) + np.uint64(1))
        else:
            half, below = 1 << level - 1, self.blocks[level - 1]
            new = mixed(below[have:len(below) - half] * _LEFT + below[have + half:] * _RIGHT)
        self.blocks[level] = np.concatenate([self.blocks[level], new])

    def _catch(self, level: int, first: int, last: int) -> None:
        """Compare the blocks that begin in ``first`` … ``last - 1`` with their catchers."""
        size, hashes = 1 << level, self.blocks[level]
        step = max(1, size >> 1)
        later = np.arange(max(first, size - step + 1), last)
        earlier = later - 1 if level == 0 else (later - step - 1) // step * step
        later, earlier = later[earlier >= 0], earlier[earlier >= 0]
        hit = np.flatnonzero(hashes[later] == hashes[earlier])
        if not len(hit):
            return
        later, earlier = later[hit], earlier[hit]
        new = ~self._held(earlier, later + size, step)
        later, earlier = later[new].tolist(), earlier[new].tolist()
        reached: dict[int, tuple[int, int]] = {}
        for j, i in zip(later, earlier, strict=True):
            period = j - i
            start, end = reached.get(period, (0, 0))
            if start <= i and j + size <= end:
                continue
            if period in self.open and self.open[period] <= i:
                continue
            if not np.array_equal(self.words[i:i + size], self.words[j:j + size]):
                continue
            back = _agreeing(self.words[:i][::-1], self.words[:j][::-1])
            reached[period] = (i - back, self._advance(period, i - back, j + size))

    def _held(self, starts: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
        """Which of the squares, whose last words are new, lie inside a stretch with a period up to ``most``."""
        known = self.recent + [(s, len(self.words), p) for p, s in self.open.items()]
        at = np.array(sorted((s, e) for s, e, p in known if p <= most), dtype=np.int64).reshape(-1, 2)
        if not len(at):
            return np.zeros(len(starts), dtype=bool)
        furthest = np.maximum.accumulate(at[:, 1])
        place = np.searchsorted(at[:, 0], starts, side="right")
        return (place > 0) & (furthest[np.maximum(place, 1) - 1] >= ends)

    def _advance(self, period: int, start: int, known: int) -> int:
        """Go on comparing behind ``known``, up to which the stretch holds; its end."""
        end = known + _agreeing(self.words[known:], self.words[known - period:])
        if end == len(self.words):
            self.open[period] = start
        else:
            self.open.pop(period, None)
            self.recent.append((start, end, period))
            if end - start >= max(LEAST_WORDS, TIMES * period):
                self.closed.append((start, end, period))
        return end

    def runs(self) -> list[Run]:
        """(start, length, period) of the runs so far, by start, then period."""
        found: dict[tuple[int, int], int] = {}
        for start, end, period in self.closed + [(s, len(self.words), p) for p, s in self.open.items()]:
            found[start, end] = min(period, found.get((start, end), period))
        return sorted((start, end - start, period) for (start, end), period in found.items()
                      if end - start >= max(LEAST_WORDS, TIMES * period))


def runs_of(words: list[bytes], step: int = STEP) -> list[Run]:
    """The runs of a list of words, appended ``step`` at a time."""
    numbers: dict[bytes, int] = {}
    numbered = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    if len(numbers) == len(words):
        return []
    catchers = Catchers()
    for i in range(0, len(numbered), step):
        catchers.append(numbered[i:i + step])
    return catchers.runs()


def strongest(runs: list[Run]) -> Run | None:
    """The run of the greatest exact length / period, then the smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that are not in a run behind its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(depth)[:-1].tolist(), strict=True) if d == 0]


def detected(docs: DataFrame, edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per document (see SCHEMA): its runs, the strongest of them, null where there is
    none, and the words left when every run keeps its first period only, joined by one space.

    ``edit`` gets a doc_id and the words and gives the words to look at.
    """
    ship(docs.sparkSession)
    record = lambda r: None if r is None else {"start": r[0], "length": r[1], "period": r[2]}
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            counts, runs, kept = [], [], []
            for doc_id, text in zip(ids.to_pylist(), texts_of(batch), strict=True):
                words = text.split()  # of bytes: at exactly the white space named above
                if edit is not None:
                    words = edit(doc_id, words)
                counts.append(len(words))
                runs.append(runs_of(words))
                kept.append(b" ".join(collapsed(words, runs[-1])).decode())
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(counts, pa.int64()),
                pa.array([[record(r) for r in found] for found in runs], pa.list_(kind)),
                pa.array([record(strongest(found)) for found in runs], kind),
                pa.array(kept, pa.string()),
            ], ["doc_id", "n_words", "runs", "strongest", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(each, SCHEMA)
