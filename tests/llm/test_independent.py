"""Operators against second implementations that share no code with them."""

from __future__ import annotations

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from laborloom.llm import chat_trees, fingerprints, secret_scan, texthash, toxicity
from laborloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WIDE, NARROW = (1 << 64) - 1, (1 << 32) - 1


def plain_print(text):
    """A fingerprint byte by byte."""
    if not text:
        return "1::"
    before, ones = [0] * 7, []
    for byte in text:
        before = [byte, *before[:6]]
        r = sum((b + 1) * ((2 * j + 1) * 0x9E3779B1 & NARROW) for j, b in enumerate(before)) & NARROW
        r = (r ^ r >> 15) * 0x85EBCA6B & NARROW
        r ^= r >> 13
        ones.append(len(bin(r)) - len(bin(r).rstrip("1")))
    size = 1
    while sum(n >= size for n in ones) >= 64:
        size += 1
    signatures = []
    for least in (size, size + 1):
        out, value, power = "", 0, 1
        for at, byte in enumerate(text):
            value, power = (value + (byte + 1) * power) & WIDE, power * texthash.BASE & WIDE
            if ones[at] >= least or at == len(text) - 1:
                x = (value ^ value >> 30) * 0xBF58476D1CE4E5B9 & WIDE
                x = (x ^ x >> 27) * 0x94D049BB133111EB & WIDE
                out += chr(fingerprints.ALPHABET[(x ^ x >> 31) >> 58])
                value, power = 0, 1
        signatures.append(out)
    return f"{1 << size}:{signatures[0]}:{signatures[1]}"


def plain_likeness(a, b):
    if a == b:
        return 1.0
    (p, a1, a2), (q, b1, b2) = a.split(":"), b.split(":")
    of_a, of_b = {int(p): a1, 2 * int(p): a2}, {int(q): b1, 2 * int(q): b2}
    best = 0.0
    for size in of_a.keys() & of_b.keys():
        x, y = of_a[size], of_b[size]
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            last, row[0] = row[0], i
            for j, d in enumerate(y, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
        best = max(best, 1 - row[-1] / max(1, len(x), len(y)))
    return best


def test_fingerprints_byte_by_byte(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    rows += [(None, None), (None, "b" * 900), (None, "a"), (10**9, ""), (10**9 + 1, "z" * 300 + "日本 🙂 " * 400)]
    rows += [(10**9 + 2, "same words " * 30)] * 3
    rows += [(10**9 + 3, " ".join(map(str, range(9000)))), (10**9 + 4, " ".join(map(str, range(9100))))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(fingerprints.compare_editions(frame).drop("near_edited", "near_next").collect(), key=str)
    likely = {(r.doc_id, r.fingerprint): (r.near_edited, r.near_next) for r in fingerprints.compare_editions(frame).collect()}
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = []
    for n, (i, text) in enumerate(ordered):
        after = ordered[(n + 1) % len(ordered)][1]
        quarter = len(text) // 4
        new = text[:len(text) - quarter] + after[:quarter]
        own, other, following = (plain_print(t.encode()) for t in (text, new, after))
        want.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), own, other))
        if ordered.count((i, text)) == 1:
            assert likely[i, own] == (plain_likeness(own, other), plain_likeness(own, following))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


KEYED = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def plain_spans(text):
    """Findings of the rules, character by character."""
    found, low, n = [], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text), len(text)

    def value_after(at):
        if text[at:at + 1] in ("'", '"'):
            at += 1
        while text[at:at + 1] == " ":
            at += 1
        if text[at:at + 1] not in (":", "="):
            return None
        at += 1
        while text[at:at + 1] == " ":
            at += 1
        if text[at:at + 1] in ("'", '"'):
            at += 1
        end = at
        while end < n and text[end] in KEYED:
            end += 1
        return (at, end) if end > at else None

    at = 0
    while at < n:
        for name in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            value = value_after(at + len(name)) if low.startswith(name, at) else None
            if value:
                if value[1] - value[0] >= 6:
                    found.append((at, 0, value[1]))
                at = value[1]
                break
        else:
            at += 1
    for kind, head, letters, least in ((1, "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 20), (2, "", "0123456789abcdef", 24)):
        at = 0
        while at < n:
            end = at + len(head)
            if not text.startswith(head, at) or end >= n or text[end] not in letters:
                at += 1
                continue
            while end < n and text[end] in letters:
                end += 1
            if end - at >= least:
                found.append((at, kind, end))
            at = end
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(found)]


def test_rules_character_by_character(spark):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    assert sum(len(plain_spans(t)) > 0 for t in texts) > 5
    draw = random.Random(2)
    pieces = ["password", "PassWd", "secret", "ſecret", "toKen", "toKen", "api_key", "apikey", "api__key", '"', "'", " ", "  ", "\t",
              ":", "=", "==", "abc", "abcdef", "0123456789ab", "AKIA", "AKIAAKIA", "ABCDEFGH", "0af9" * 7, "é", "\n", ".", "-"]
    texts += ["".join(draw.choice(pieces) for _ in range(draw.randrange(25))) for _ in range(20000)]
    for text in texts:
        assert secret_scan.base_spans(text) == plain_spans(text), text


def test_secret_query_gives_the_plain_findings(spark):
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        spans = plain_spans(r.text or "")
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want[r.doc_id] = (*(sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")), hashlib.sha256(line.encode()).hexdigest())
    got = QUERIES["op3_secret_scan"](spark, SF).collect()
    assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got} == want


def test_isotonic_fit_is_the_greatest_of_least_means():
    draw = np.random.default_rng(6)
    for _ in range(60):
        n = int(draw.integers(2, 40))
        score, y = draw.integers(0, 12, n) / 8, draw.integers(0, 2, n)
        if y.min() == y.max():
            continue
        weight = draw.integers(1, 4, n).astype(float)
        values = np.unique(score)
        w, v = (np.array([x[score == s].sum() for s in values]) for x in (weight, weight * y))
        fit = [max(min(v[a:b + 1].sum() / w[a:b + 1].sum() for b in range(i, len(values))) for a in range(i + 1))
               for i in range(len(values))]
        toxic, clean = (0.1 * weight[y == k].mean() for k in (1, 0))
        at, share = toxicity.isotonic(score, y, weight)
        assert (np.diff(share) >= 0).all() and at.tolist() == sorted(at.tolist())
        pools = [np.flatnonzero(np.isclose(fit, f)) for f in dict.fromkeys(np.round(fit, 9))]
        want = np.maximum.accumulate([(v[p].sum() + toxic) / (w[p].sum() + toxic + clean) for p in pools])
        assert at.tolist() == [values[p[k]] for p in pools for k in (0, -1)]
        assert np.allclose(share, np.repeat(want, 2))


def test_trees_are_those_of_a_plain_greedy_fit():
    draw = np.random.default_rng(8)
    x = draw.normal(size=(300, 4))
    y = (x[:, 0] * x[:, 1] + 0.5 * x[:, 2] + draw.normal(scale=0.3, size=300) > 0).astype(float)
    got = toxicity.Trees(rounds=6, depth=3).fit(x, y)
    binned = got._binned(x)
    score = np.full(300, np.log(y.mean() / (1 - y.mean())))

    def grow(rows, depth, g, h, out):
        if depth:
            whole = g[rows].sum()**2 / (h[rows].sum() + 1)
            options = [(sum(g[p].sum()**2 / (h[p].sum() + 1) for p in (rows[binned[rows, j] <= c], rows[binned[rows, j] > c])) - whole, -j, -c)
                       for j in range(4) for c in range(33)]
            gain, j, c = max(options)
            if gain > 1e-9:
                left = binned[rows, -j] <= -c
                grow(rows[left], depth - 1, g, h, out)
                grow(rows[~left], depth - 1, g, h, out)
                return
        out[rows] = 0.15 * g[rows].sum() / (h[rows].sum() + 1)

    for _ in range(6):
        p = 1 / (1 + np.exp(-score))
        step = np.zeros(300)
        grow(np.arange(300), 3, y - p, p * (1 - p), step)
        score = score + step
    assert np.allclose(got.score(x), score)


def test_paths_of_random_trees(spark):
    draw, rows = random.Random(3), []
    for tree in range(8):
        for node in range(1, draw.choice([1, 2, 40, 70]) + 1):
            parent = None if node == 1 or draw.random() < 0.05 else draw.randrange(max(1, node - 6), node)
            rows.append((f"t{tree}", tree, node, parent, draw.choice(["user", "assistant"]),
                         draw.choice(["", "<s>", "a\\<|im_end|>\n", "日本"]) + str(node), draw.randrange(5) / 4))
    by = {(r[0], r[2]): r for r in rows}
    inner = {(r[0], r[3]) for r in rows}
    paths = {}
    for tree, node in by.keys() - inner:
        way, at = [], node
        while at is not None:
            way.append(by[tree, at])
            at = by[tree, at][3]
        paths[tree, node] = (sum(r[6] for r in way), [(r[4], r[5]) for r in reversed(way)])
    frame = spark.createDataFrame(rows, "tree string, tree_id long, node long, parent long, role string, text string, score double")
    for branches in (None, 1, 4):
        want = {}
        for tree in {t for t, _ in paths}:
            leaves = sorted((n for t, n in paths if t == tree), key=lambda n: (-paths[tree, n][0], n))
            want.update({(tree, n): paths[tree, n] for n in leaves[:branches]})
        got = chat_trees.conversations(frame.repartition(3), branches).select(
            F.concat(F.lit("t"), "tree_id").alias("tree"), "leaf", "path_score",
            chat_trees.turns_read(F.col("formatted")).alias("turns"), chat_trees.loss_read(F.col("segments")).alias("loss")).collect()
        assert {(r.tree, r.leaf): (r.path_score, [(t.role, t.text) for t in r.turns]) for r in got} == want
        assert all(r.loss == "".join(t.text for t in r.turns if t.role == "assistant") for r in got)


def test_threads_with_nulls_ties_and_many_turns(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"m{t}") for t in range(2500)]
    rows += [(2, 5, "user", "b"), (2, 5, "user", "a"), (2, 5, "assistant", "z"), (2, None, "user", "first"), (2, 9, None, None),
             (2, 9, None, None), (None, 1, "user", "nobody")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = chat_trees.conversations(chat_trees.linear_trees(frame)).select(
        "tree_id", chat_trees.turns_read(F.col("formatted")).alias("turns")).collect()
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {r.tree_id: [(t.role, t.text) for t in r.turns] for r in got} == want
    assert chat_trees.conversations(chat_trees.linear_trees(frame.where("false"))).count() == 0
