"""Operators against brute force, on small tables with the awkward cases, and on the test tables."""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from laborloom.llm import (
    bpe, chat_trees, exact_dedup, fingerprints, license_scan, minhash_dedup, packing, secret_scan, substring_dedup,
    toxicity)
from laborloom.llm.oracle import ORACLE_SQL
from laborloom.llm.queries import QUERIES, VOCABULARY
from laborloom.llm.shared import components, frequent_keys, saved, with_bounds

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = " ".join(f"word{i} and" for i in range(60))
TEXTS = [None, "", " \t\n", "one", "One", "one two three", PROSE, PROSE, PROSE + " tail", PROSE.upper(),
         "x " * 3000 + PROSE, "日本 語\x00é\x1c🙂 <|endoftext|> a  b\n c", "a" * 5000, PROSE + " password = abcdef1"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or ""), True, "clash") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, kept boolean, hash string").repartition(3)


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


def pairs(frame):
    return sorted((r.doc_id, r.text or "") for r in frame.collect())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_no_rows(spark, docs):
    none = docs.where("false")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert exact_dedup.decisions(none).count() == exact_dedup.survivors(none).count() == 0
    assert substring_dedup.deduplicated(none).count() == minhash_dedup.near_duplicates(none).count() == 0
    assert packing.packed(none, VOCABULARY).count() == license_scan.scanned(none).count() == 0
    assert bpe.digests(bpe.encoded(none, VOCABULARY), VOCABULARY).count() == 0
    assert fingerprints.compare_editions(none).count() == 0
    assert toxicity.without_toxic(none, labels).count() == 0
    assert secret_scan.without_secrets(none, secret_scan.network(none)).count() == 0


@pytest.mark.parametrize("frame", ["docs", "real"])
def test_exact_groups(frame, request):
    rows = pairs(request.getfixturevalue(frame))
    groups = {}
    for i, t in rows:
        groups.setdefault(t.translate(dict.fromkeys(map(ord, exact_dedup.WHITE))), []).append((-len(t), i))
    want = {i: (min(g)[1], len(g), min(g)[1] == i, sha(k)) for k, g in groups.items() for _, i in g}
    got = exact_dedup.decisions(request.getfixturevalue(frame)).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == want and len(got) == len(rows)


def test_exact_survivors_keep_columns_and_one_of_repeated_rows(docs):
    out = exact_dedup.survivors(docs.unionByName(docs))
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(
        r.doc_id for r in exact_dedup.decisions(docs).where("kept").collect())


def test_hot_group_of_copies(spark):
    many = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy").otherwise(
        F.concat(F.lit("text "), F.col("id"))).alias("text"))
    got = exact_dedup.decisions(many)
    assert got.where("kept").count() == 4001 and got.where("group_size = 2000").count() == 2000


@pytest.mark.parametrize("frame", ["docs", "real"])
def test_substrings(frame, request):
    first, want = {}, {}
    for i, t in pairs(request.getfixturevalue(frame)):
        w = WORDS.findall(t)
        gone = [False] * len(w)
        for s in range(len(w) - 12):
            if first.setdefault(tuple(w[s:s + 13]), i) < i:
                gone[s:s + 13] = [True] * 13
        want[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    got = substring_dedup.deduplicated(request.getfixturevalue(frame)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == want


def near_groups(rows, words, percent=80):
    sets, lower = [], str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for _, t in rows:
        w = WORDS.findall(t.translate(lower))
        sets.append({tuple(w[s:s + words]) for s in range(max(1, len(w) - words + 1))} if w else set())
    home = list(range(len(rows)))
    holders: dict = {}
    for n, s in enumerate(sets):
        shared = Counter(m for h in s for m in holders.setdefault(h, []))
        for m, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[m]) - both):
                a, b = sorted((home[n], home[m]))
                home = [a if h == b else h for h in home]
        for h in s:
            holders[h].append(n)
    return {rows[n][0]: (len(sets[n]), rows[home[n]][0]) for n in range(len(rows))}


@pytest.mark.parametrize(("frame", "words"), [("docs", 4), ("real", 4), ("real", 5)])
def test_near_duplicates(frame, words, request):
    want = near_groups(pairs(request.getfixturevalue(frame)), words)
    got = minhash_dedup.near_duplicates(request.getfixturevalue(frame), words=words).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_copies_of_one_text_whose_links_form_a_chain(spark):
    base = [f"w{i}" for i in range(200)]
    texts = []
    for step in range(60):  # each differs from its neighbours by one word, from far ones by many
        base = [*base]
        base[3 * step] = f"new{step}"
        texts.append(" ".join(base))
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash_dedup.near_duplicates(frame, words=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_groups(rows, 4)


def test_bounds_of_frequent_and_rare_keys(spark):
    rows = [(7, n % 900) for n in range(3_000)] + [(8, n) for n in range(150)] + [(100 + n % 40, n) for n in range(400)]
    frame = saved(spark.createDataFrame(rows, "key long, value long"))
    assert {k for k, _ in frequent_keys(frame, "key", frame.count())} == {7, 8}
    want = Counter((k, v, min(w for j, w in rows if j == k), max(w for j, w in rows if j == k)) for k, v in rows)
    assert Counter(map(tuple, with_bounds(frame, "key", "value").select("key", "value", "lo", "hi").collect())) == want
    assert with_bounds(saved(frame.limit(0)), "key", "value").count() == 0


def test_components_of_a_long_path(spark):
    links = spark.range(300).selectExpr("(id * 7) % 301 AS a", "((id + 1) * 7) % 301 AS b")
    assert {r.component for r in components(saved(links)).collect()} == {0}


def test_odd_sketches_follow_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
    far = np.sort(base[300:])
    near = np.sort(np.concatenate([base[:290], base[300:310]]))
    s = minhash_dedup.odd_sketches(minhash_dedup.min_hashes([np.sort(base[:300]), near, far]))
    odd = [int(np.bitwise_count(s[0] ^ s[i]).sum()) for i in (1, 2)]
    assert odd[0] < minhash_dedup.MOST_ODD < odd[1]


@pytest.mark.parametrize("frame", ["docs", "real"])
def test_encoding_as_the_library(frame, request):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    frame = request.getfixturevalue(frame)
    want = {}
    for i, t in pairs(frame):
        ids = library.encode(t, add_special_tokens=False).ids
        want[i] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    got = bpe.digests(bpe.encoded(frame, VOCABULARY), VOCABULARY).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


@pytest.mark.parametrize("text", ["x" + " " * 1_500_000 + "y", "\n" * 1_200_000, "a" * 200_000, "a <|endoftext|>b", ""])
def test_both_encoders_on_extreme_texts(text):
    want = Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids
    for encoder in (packing.library_encoder(VOCABULARY), bpe.encoder(VOCABULARY)):
        assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == want


@pytest.mark.parametrize("frame", ["docs", "real"])
def test_packing(frame, request):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    frame = request.getfixturevalue(frame)
    ids = {i: np.array([*library.encode(t, add_special_tokens=False).ids, 0], dtype="<u4") for i, t in pairs(frame)}
    at, sequences = Counter(), {}
    for r in sorted(packing.packed(frame, VOCABULARY).collect(), key=lambda r: (r.doc_id, r.start)):
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        at[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert at == {i: len(x) for i, x in ids.items()}
    padding = 0
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 1024
        padding += 1024 - end if end & (end - 1) else 0
    assert padding <= 0.02 * sum(at.values())


def test_cuts_are_as_good_as_any():
    rng = np.random.default_rng(2)
    for _ in range(30):
        at, penalty = np.arange(1, 40), rng.integers(0, 9, 39)
        cost = [0]
        for j in at.tolist():
            cost.append(min(cost[i] + 12 - (j - i) for i in range(max(0, j - 12), j)) + int(penalty[j - 1]))
        cuts = packing.best_cuts(at, penalty, 12)
        got = sum(12 - (b - a) + int(penalty[b - 1]) for a, b in zip([0, *cuts], cuts, strict=False))
        assert got + cuts[-1] == min(cost[j] + j for j in range(27, 40))


def test_fingerprints(docs):
    rows = sorted(pairs(docs))
    got = {r.doc_id: r for r in fingerprints.compare_editions(docs).collect()}
    for n, (i, t) in enumerate(rows):
        new = fingerprints.edited(t, rows[(n + 1) % len(rows)][1])
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), sha(new))
        own, other = fingerprints.fingerprints([t.encode(), new.encode()])
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (own, other)
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[6].fingerprint == got[7].fingerprint and got[6].near_next == 1.0


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    rng = np.random.default_rng(3)
    left, right = (["".join(rng.choice(list("ABc/"), rng.integers(0, 65))) for _ in range(200)] for _ in "ab")
    assert fingerprints.edit_distances(left, right).tolist() == [plain(a, b) for a, b in zip(left, right, strict=True)]


def test_secret_rules_and_redaction(docs):
    text = 'token: token = abcdef1 PASSWD="abc" api_key=Zz9/+_.=- AKIA' + "A1" * 8 + " " + "0af" * 8 + " ſecret=abcdef"
    assert [(k, text[a:b]) for k, a, b in secret_scan.base_spans(text)] == [
        ("assign", "api_key=Zz9/+_.=-"), ("access", "AKIA" + "A1" * 8), ("hex", "0af" * 8)]
    net = secret_scan.network(docs)
    got = {r.doc_id: r for r in secret_scan.scanned(docs, net).collect()}
    assert (got[13].n_assign, got[13].n_access, got[13].n_hex, got[0].spans) == (1, 0, 0, "")
    out = {r.doc_id: r for r in secret_scan.without_secrets(docs, net).collect()}
    assert out[13].text == PROSE + " " + secret_scan.REDACTED and out[13].n_chars == len(out[13].text)
    assert out[0].text is None and out[6].text == PROSE


def test_candidates_beside_findings_of_any_kind():
    rng = np.random.default_rng(4)
    parts = ["0af" * 9, "token=" + "Qz" * 12, "AKIA" + "B7" * 9, "plain", "deadbeef-" * 4, "K" * 20, "x:" + "9c" * 15]
    for _ in range(40):
        text = " ".join(rng.choice(parts, 30)) + "".join(rng.choice(parts, 4))
        taken = secret_scan.base_spans(text)
        for start, end, known in secret_scan.candidates(text, taken):
            assert known == any(a < end and start < b for _, a, b in taken)


def test_network_knows_keys_it_has_not_seen():
    made = secret_scan.made_findings(2400)
    net = secret_scan.trained([w for w, _ in made[:1800]], [y for _, y in made[:1800]])
    held = made[1800:]
    found = net.scores(secret_scan._codes([w for w, _ in held])) >= net.threshold
    truth = np.array([y for _, y in held]) == 1
    assert found[truth].mean() >= 0.95 and found[~truth].mean() <= 0.05


def test_network_reads_long_runs_to_their_end(docs):
    rng = np.random.default_rng(8)
    net = secret_scan.network(docs)
    alnum = list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
    words = "service module handler common library python project resource template archive".split()
    harmless = lambda: "/" + "/".join(rng.choice(words, rng.integers(8, 20)))
    late, plain = [], []
    for i in range(100):
        key = "".join(rng.choice(alnum, 40))
        late.append(f"see {harmless()}{'/_-='[i % 4]}{key}{'/index/of/templates/' * (i % 3)} here")
        plain.append(f"see {harmless()} here")
    found = [spans for _, spans in secret_scan.all_spans(late, net)]
    assert np.mean([len(s) == 1 for s in found]) >= 0.95
    assert np.mean([bool(spans) for _, spans in secret_scan.all_spans(plain, net)]) <= 0.05
    text = "x" * 3000
    assert [at for at, _ in secret_scan.windows(text, 0, 100)] == [0, 24, 48, 52]
    assert all(len(codes) == secret_scan.LENGTH for _, codes in secret_scan.windows(text, 0, 2999))


def test_parts_of_a_candidate_beside_a_finding_are_scored(docs):
    rng = np.random.default_rng(9)
    net = secret_scan.network(docs)
    alnum = list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
    hits = []
    for i in range(60):
        key = "".join(rng.choice(alnum, 40))
        head = ("AKIA" + "B7" * 8 + "/", "0af" * 8 + "/", "0af" * 8 + "+Z")[i % 3]
        text = f"see {head}{key} here"
        (base, spans), = secret_scan.all_spans([text], net)
        assert set(base) <= set(spans)
        hits.append(key[4:] not in secret_scan.redacted(text, spans))
    assert np.mean(hits) >= 0.95
    text = "token=abcdefgh " + "x" * 20 + "0af" * 10 + "y" * 15 + "=" + "AKIA" + "B7" * 9 + "/" * 15 + " " + "q" * 16
    base = secret_scan.base_spans(text)
    parts = list(secret_scan.uncovered(secret_scan.candidates(text, base), secret_scan.merged(base)))
    assert [text[a:b] for a, b in parts] == ["x" * 20, "y" * 15 + "=", "q" * 16]


def test_every_disguise_counts_wherever_it_is():
    lexicon = toxicity.Lexicon()
    many = "a.b x-1 " * 50_001
    assert toxicity.features(many + "id1ot", lexicon) == toxicity.features("id1ot " + many[:-1], lexicon)
    assert toxicity.features(many + "id1ot", lexicon)[15] == np.log1p(1)
    for sign in "0123456789@$!|+€*._-٣":
        assert toxicity.DISGUISED.findall(f"you ab{sign}cd you") == [f"ab{sign}cd"]
        assert toxicity.features(f"you ab{sign}cd you", lexicon)[14] > 0
    assert toxicity.features("you fr€ak", lexicon)[15] == np.log1p(1)


def test_rare_toxic_labels_are_learned_by_class(spark):
    insult = "you are a grumbleflop and a snorkelwit, "
    rows = [(i, (insult if i % 200 == 0 else "we are at the lake with a friend, ") + f"number {i % 7} of it.", int(i % 200 == 0))
            for i in range(8000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    given = toxicity.training_rows(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), 80).collect()
    assert len(given) == 80 and sum(r.toxic for r in given) == 20
    assert all({r.part >= 8 for r in given if r.toxic == v} == {True, False} for v in (0, 1))
    learnable = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    assert round(sum(r.weight for r in given)) == len(learnable)
    for few in (1, 2):
        labels = frame.where(f"toxic = 0 OR doc_id < {few * 200}").select("doc_id", "toxic")
        if labels.where("toxic = 1").where(~toxicity.held_out()).count():
            assert toxicity.fitted(frame, labels, 80).trees is not None
    model = toxicity.fitted(frame, frame, 80)
    bad, good = model.scores([insult + "number 3 of it.", "we are at the lake with a friend, number 9 of it."])
    assert bad > 0.2 > 0.05 > good
    assert toxicity.fitted(frame, frame.where("toxic = 0"), 80).trees is None


def test_toxicity_learns_one_text_of_an_id_that_repeats(spark):
    frame = spark.createDataFrame(
        [(7 if i % 3 else i, None if i == 1 else f"text {i % 50}", i % 2) for i in range(900)],
        "doc_id long, text string, toxic int")
    rows = toxicity.training_rows(frame.repartition(5), frame, 50).collect()
    assert len(rows) == 50
    once = toxicity.training_rows(frame.repartition(3).dropDuplicates(["doc_id"]).where("doc_id <> 7"), frame, 900)
    many = toxicity.training_rows(frame.repartition(3), frame, 900)
    assert 0 <= many.count() - once.count() <= 1
    assert sorted(many.collect()) == sorted(toxicity.training_rows(frame.repartition(4), frame, 900).collect())


def test_toxicity_on_held_out_rows(spark):
    got = QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = got.where("held_out").join(labels, "doc_id").collect()
    toxic = [r.score for r in rows if r.toxic]
    clean = [r.score for r in rows if not r.toxic]
    order = np.mean([(t > c) + 0.5 * (t == c) for t in toxic for c in clean])
    assert order >= 0.85 and np.mean([c >= 0.3 for c in clean]) <= 0.05
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in got.collect())


def test_licences(spark):
    lines = ["Intro.\nLicensed under the Apache License, Version 2.0.\nMore", "Released under the MIT License. x",
             "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.",
             "no rights here", None,
             "Redistribution and use in source and binary forms, with or without modification, are permitted.\n"
             "Neither the name of X nor the names of its contributors may be used to endorse or promote products."]
    frame = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.doc_id: r.licences for r in license_scan.scanned(frame).collect()}
    assert got == {0: ["Apache-2.0"], 1: ["MIT"], 2: ["CC-BY-NC-4.0"], 3: ["GPL-3.0"], 4: [], 5: [], 6: ["BSD-3-Clause"]}


def test_standard_licence_texts(spark):
    mit = """MIT License

Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY."""
    bsd = """Copyright (c) 2020, Example Inc.
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice.

3. Neither the name of Example Inc. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
    gnu = """This {what} is free software{mark} you can redistribute it and/or modify
it under the terms of the GNU {name} as published by
the Free Software Foundation{version}.

This {what} is distributed in the hope that it will be useful, but WITHOUT
ANY WARRANTY."""
    gpl = lambda version, mark=";": gnu.format(
        what="program", mark=mark, name="General Public License", version=version)
    later = "{} either version {} of the License, or\n(at your option) any later version"
    mpl = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
    apache = """Licensed under the Apache License, Version 2.0 (the
"License"); you may not use this file except in compliance
with the License."""
    marked = lambda text, mark: "\n".join(f"{mark} {line}".rstrip() for line in text.split("\n"))
    given = [
        (mit, ["MIT"]), (marked(mit, " *"), ["MIT"]), (marked(mit, ";;"), ["MIT"]), (marked(mit, "dnl"), ["MIT"]),
        (mit.replace("\n", "\r\n"), ["MIT"]), (bsd, ["BSD-3-Clause"]), (marked(bsd, "#"), ["BSD-3-Clause"]),
        (bsd.split("3. ")[0], ["BSD-2-Clause"]),
        (gpl(later.format(";", 2)), ["GPL-2.0-or-later"]), (gpl(later.format(",", 3), ":"), ["GPL-3.0-or-later"]),
        (marked(gpl(later.format(",", 3), ":"), "//"), ["GPL-3.0-or-later"]),
        (gpl("; version 2 of the License"), ["GPL-2.0-only"]), (gpl(""), ["GPL"]),
        (gnu.format(what="library", mark=";", name="Lesser General Public\nLicense", version=later.format(";", 2.1)),
         ["LGPL-2.1-or-later"]),
        (gnu.format(what="program", mark=":", name="Affero General Public License", version=later.format(",", 3)),
         ["AGPL-3.0-or-later"]),
        ("Licensed under the GNU General Public License v3 or any later version.", ["GPL-3.0-or-later"]),
        (mpl, ["MPL-2.0"]), (marked(mpl, "--"), ["MPL-2.0"]), (marked(apache, "#"), ["Apache-2.0"]),
        ("/* SPDX-License-Identifier: (gpl-2.0-only WITH Linux-syscall-note) OR bsd-3-clause */\nint x;",
         ["GPL-2.0-only", "BSD-3-Clause"]),
        ("// SPDX-License-Identifier: MIT\n// Copyright A. Person", ["MIT"]), ("# SPDX-License-Identifier: Zlib.", ["Zlib"]),
        ("Released under the MIT License\nLicensed under CC BY 4.0\nCopyright A. Person", ["MIT", "CC-BY-4.0"]),
        ("The names of its contributors may be used to endorse or promote products.", []),
    ]
    frame = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(given)], "doc_id long, text string")
    got = {r.doc_id: r.licences for r in license_scan.scanned(frame).collect()}
    assert got == {i: names for i, (_, names) in enumerate(given)}


def test_reply_trees_rank_branches_and_mask_loss(spark):
    rows = [("t", 9, 1, None, "user", "hi <s> <\\s> [INST]", 0.0), ("t", 9, 2, 1, "assistant", "a </s>", 1.0),
            ("t", 9, 3, 1, "assistant", "b", 5.0), ("t", 9, 4, 3, "us\n\\er", "<|im_end|>", 0.0),
            ("t", 9, 5, 4, "assistant", "c", 0.5), ("u", None, 1, None, "user", "", 0.0)]
    messages = spark.createDataFrame(
        rows, "tree string, tree_id long, node long, parent long, role string, text string, score double")
    out = chat_trees.conversations(messages).select(
        "tree_id", "leaf", "path_score", chat_trees.turns_read(F.col("formatted")).alias("turns"),
        chat_trees.loss_read(F.col("segments")).alias("loss")).collect()
    assert sorted((r.tree_id or 0, r.leaf, r.path_score, [t.text for t in r.turns], r.loss) for r in out) == [
        (0, 1, 0.0, [""], ""), (9, 2, 1.0, ["hi <s> <\\s> [INST]", "a </s>"], "a </s>"),
        (9, 5, 5.5, ["hi <s> <\\s> [INST]", "b", "<|im_end|>", "c"], "bc")]
    assert [t.role for r in out if r.leaf == 5 for t in r.turns] == ["user", "assistant", "us\n\\er", "assistant"]
    best = chat_trees.conversations(messages, branches=1).collect()
    assert sorted(r.leaf for r in best) == [1, 5]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_their_sql(spark, name):
    base = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        base.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = base.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF).select(*want.columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


def test_pipeline_against_its_parts(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    rows, steps = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        rows = saved(stage(spark, rows, SF))
        steps[name] = rows
        assert rows.columns == documents.columns or name == "packing"
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    toxic = toxicity.scored(documents.select("doc_id", "text"), toxicity.fitted(documents, labels)).where("score >= 0.3")
    ids = lambda f: {r.doc_id for r in f.select("doc_id").collect()}
    assert ids(steps["toxicity"]) == ids(documents) - ids(toxic)
    near = near_groups(pairs(steps["exact_dedup"]), 5)
    assert ids(steps["minhash_near_dedup"]) == {i for i, (_, c) in near.items() if i == c}
    assert ids(steps["secret_scan"]) == ids(steps["minhash_near_dedup"]) == ids(steps["packing"])
    assert not any(secret_scan.base_spans(t) for _, t in pairs(steps["secret_scan"]))
    assert corpus_pipeline.run(spark, SF).count() == steps["packing"].count()
