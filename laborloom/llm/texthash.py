"""Hashes of byte spans and word windows, computed for many texts at once with numpy.

A span's hash is a polynomial of its bytes, taken from prefix sums and shifted to position
zero, so equal spans hash alike wherever they stand. Everything is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BLOCK_BYTES = 1 << 20
_powers: dict[int, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    """base**0 … base**(n-1)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 2 * BLOCK_BYTES), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps)
        if n <= 4 * BLOCK_BYTES:
            _powers[base] = have
    return have[:n]


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [t or b"" for t in batch.column(name).cast(pa.large_binary()).to_pylist()]


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes; a longer text is a range of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def joined(texts: list[bytes], gap: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array with ``gap`` before each; starts and ends of the texts."""
    data = np.frombuffer(gap + gap.join(texts), dtype=np.uint8)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(lengths + len(gap))
    return data, ends - lengths, ends


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(BASE, len(data)), out=sums[1:])
    shift = _power(INVERSE, len(data) + 1)[starts]
    return mixed((sums[ends] - sums[starts]) * shift + (ends - starts).astype(np.uint64))


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and for each text the index of its first word (one more at the end).

    Words are runs without space or ``\\x09-\\x0D``; ``lower`` maps A-Z to a-z first.
    """
    data, starts, _ = joined(texts, b" ")
    if lower:
        upper = (data >= 65) & (data <= 90)
        data = data + (upper.astype(np.uint8) << 5)
    white = np.ones(len(data) + 2, dtype=bool)
    white[1:-1] = (data == 32) | ((data >= 9) & (data <= 13))
    first = np.flatnonzero(white[:-2] & ~white[1:-1])
    last = np.flatnonzero(~white[1:-1] & white[2:]) + 1
    bounds = np.append(np.searchsorted(first, starts), len(first))
    return span_hashes(data, first, last), bounds


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, by the index of its first; runs may cross texts."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for j in range(n):
        factor = (2 * j + 3) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
        out += words[j:len(words) - n + 1 + j] * np.uint64(factor)
    return mixed(out)
