"""Near-duplicates with ids that repeat or are null, against a comparison of all rows."""

from __future__ import annotations

import random
import re

import pytest

from laborloom.llm import minhash_dedup

LAST = (1 << 63) - 1
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, words):
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[s:s + words]) for s in range(max(1, len(w) - words + 1))} if w else set()


def expected(rows, words, percent=80):
    """component_id and the row that stays, by row."""
    sets = [shingles(text, words) for _, text in rows]
    home = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and home[i] != home[j]:
                old, new = home[i], home[j]
                home = [new if h == old else h for h in home]
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[home[i]] = min(least.get(home[i], LAST), LAST if doc_id is None else doc_id)
    return [(doc_id, len(sets[i]), None if least[home[i]] == LAST else least[home[i]], least[home[i]] in (doc_id, LAST))
            for i, (doc_id, _) in enumerate(rows)]


def prose(rng, n=100):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def cases():
    rng = random.Random(9)
    a, b, c, d = (prose(rng) for _ in range(4))
    rows = [(5, a), (5, b), (7, a + " tail"), (8, b + " tail"), (9, c), (9, c), (9, d), (3, d + " end"), (None, c + " end"),
            (None, a + " more"), (None, prose(rng)), (4, None), (4, ""), (None, None), (6, "one two"), (6, "One  two")]
    lonely = prose(rng)
    rows += [(None, lonely), (None, lonely + " x"), (12, prose(rng, 40_000))]
    for i in range(40):  # chains of edits under few ids
        words = prose(rng).split()
        for _ in range(4):
            words[rng.randrange(len(words))] = "edited"
            rows.append((rng.choice([20 + i % 7, 30, None]), " ".join(words)))
    return rows


@pytest.mark.parametrize("words", [4, 5])
def test_links_of_every_text(spark, words):
    rows = cases()
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame([(*r, "clash", 1) for r in rows],
                                      "doc_id long, text string, key string, node int").repartition(1 + 3 * seed)
        got = minhash_dedup.near_duplicates(frame, words).collect()
        assert sorted(map(tuple, got), key=str) == sorted(expected(rows, words), key=str)


def test_one_text_of_each_group_stays(spark):
    rows = cases()
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, place int")
    left = minhash_dedup.survivors(frame).collect()
    assert left[0].asDict().keys() == {"doc_id", "text", "place"}
    sets = {r.place: shingles(r.text, 5) for r in left}
    same = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    close = [(i, j) for i in sets for j in sets if i < j and same(sets[i], sets[j]) and rows[i] != rows[j]]
    assert not close
    groups = expected(rows, 5)
    assert {g[2] for g in groups if g[1]} == {groups[p][2] for p in sets if groups[p][1]}
    assert sum(not s for s in sets.values()) == 3  # empty texts are linked with nothing


def templates():
    """Rows in buckets with many members that are no links, and hubs with many that are."""
    rng = random.Random(4)
    rows, doc_id = [], 100
    for _ in range(2):
        body = prose(rng, 60).split()
        for edits, rows_of in (1, 30), (4, 30), (6, 60):
            for _ in range(rows_of):
                words = list(body)
                for place in rng.sample(range(60), edits):
                    words[place] = f"x{rng.randrange(10_000)}"
                rows.append((doc_id, " ".join(words)))
                doc_id += 1
    return rows


def test_packed_blocks_and_cut_hubs_change_nothing(spark, monkeypatch):
    rows = templates()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted(expected(rows, 4), key=str)
    assert len({g[2] for g in want}) > 20  # components in crowded buckets
    monkeypatch.setattr(minhash_dedup, "IN_BLOCK", 9)
    monkeypatch.setattr(minhash_dedup, "IN_PART", 3)
    assert sorted(map(tuple, minhash_dedup.near_duplicates(frame, 4).collect()), key=str) == want


def test_links_of_a_crowded_bucket_leave_a_task_once_per_merge():
    """Close members of one bucket, each its own component: links leave for merges only, not per pair."""
    rng = random.Random(5)
    body = prose(rng, 60).split()
    texts = []
    for _ in range(40):
        words = list(body)
        words[-1] = f"x{rng.randrange(10_000)}"
        texts.append(" ".join(words))
    sets = minhash_dedup.shingle_sets([t.encode() for t in texts], 4)
    samples = minhash_dedup.min_hashes(sets)
    bands, sketches = minhash_dedup.band_keys(samples), minhash_dedup.odd_sketches(samples)
    values, counts = minhash_dedup.np.unique(bands[:, 0], return_counts=True)
    common = values[counts.argmax()]
    key = int(common.view(minhash_dedup.np.int64))
    shared = bands[:, 0] == common
    nodes = minhash_dedup.np.flatnonzero(shared).astype(minhash_dedup.np.int64)
    members = [nodes, nodes.copy(), sketches[nodes], bands[nodes], [sets[i] for i in nodes]]
    got = minhash_dedup._close(key, members, members, True, 80).to_pylist()
    assert len(nodes) > 20
    assert len(got) == len(nodes) - 1  # a spanning tree of the bucket, no more
    home = {int(n): int(n) for n in nodes}
    for link in got:
        old, new = home[link["b"]], home[link["a"]]
        home = {n: new if h == old else h for n, h in home.items()}
    assert len(set(home.values())) == 1
