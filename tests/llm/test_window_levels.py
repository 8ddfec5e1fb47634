"""Level-wise doubling of repeated windows against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from laborloom.llm import substring_dedup
from laborloom.llm.substring_dedup import Parts, lengths

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, hash string, place int"


def removed(rows, window):
    """Of (doc_id, text) rows: number of words, of removed ones, and the words that stay."""
    first, texts = {}, [(substring_dedup.LAST if i is None else i, WORDS.findall(t or "")) for i, t in rows]
    for i, w in texts:
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            first[key] = min(i, first.get(key, i))
    out = []
    for (i, w), (doc_id, _) in zip(texts, rows, strict=True):
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < i:
                gone[s:s + window] = [True] * window
        out.append((doc_id, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out, key=str)


def corpus():
    """Few words, so that short windows repeat where long ones do not; passages; periods; ids that repeat."""
    draw = random.Random(5)
    passages = [[draw.choice("abcdefgh") for _ in range(n)] for n in (12, 13, 14, 20, 60)]
    rows = [(None, None), (0, ""), (1, " \t\x0b "), (2, "a " * 4000), (3, "a " * 13), (None, "a " * 12)]
    for i in range(4, 90):
        words = [draw.choice("abcdefgh") for _ in range(draw.randrange(40))]
        for _ in range(draw.randrange(3)):
            at = draw.randrange(len(words) + 1)
            words[at:at] = draw.choice(passages)
        text = draw.choice([" ", "\n", "  "]).join(words)
        rows.append((draw.choice([i, i, i, 7, 60, None]), text))
        if i % 9 == 0:
            rows.append(rows[-1])
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("window", [1, 2, 5, 13, 16, 21])
def test_windows_as_brute_force(spark, window):
    rows = corpus()
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], COLUMNS).repartition(5)
    got = substring_dedup.deduplicated(frame, window).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == removed(rows, window)


def test_no_repeat_and_no_rows(spark):
    rows = [(i, " ".join(f"{i}w{j}" for j in range(30))) for i in range(20)]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], COLUMNS)
    assert {r.n_removed for r in substring_dedup.deduplicated(frame).collect()} == {0}
    assert substring_dedup.deduplicated(frame.where("false")).count() == 0


def test_a_level_doubles_the_one_before_within_the_same_full_window():
    assert lengths(13) == [4, 8, 13] and lengths(16) == [4, 8, 16] and lengths(1) == [1] and lengths(3) == [1, 2, 3]
    draw = random.Random(1)
    texts = [" ".join(draw.choice("abcd") for _ in range(n)).encode() for n in (300, 0, 12, 13, 50)]
    parts = Parts(texts, 13)
    assert len(parts.starts) == 288 + 0 + 0 + 1 + 38
    for shorter, longer in zip(lengths(13)[:-1], lengths(13)[1:], strict=True):
        a, b = (np.minimum(parts.offsets, 13 - n) for n in (shorter, longer))
        assert (b <= a).all() and (a + shorter <= b + longer).all() and (b + longer <= 13).all()
    words = [t.split() for t in texts]
    chosen = {}
    for start, owner, hashed in zip(parts.starts, parts.owners[parts.starts], parts.of_length(8)[0], strict=True):
        at = start - parts.firsts[owner]
        assert chosen.setdefault(tuple(words[owner][at:at + 13]), hashed) == hashed
