"""Chunked byte-level BPE against the reference library for rank files."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from laborloom.llm import chunked_bpe
from laborloom.llm.queries import QUERIES, RANKS

SF = "/root/testdata/sf0.001"
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(text):
    table = chunked_bpe.ranks_of(RANKS)
    return np.frombuffer(table.encode([regex.findall(PATTERN, text)])[0], dtype="<u4").tolist()


def test_merges_of_random_texts(library):
    rng = random.Random(1)
    alphabet = " \n\t  abcdeABCthe'sreing019.,-é日本🙂\x1c\x85​<|endoftext|>"
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert ids_of(text) == library.encode_ordinary(text)


def test_words_of_every_length_and_repeats(library):
    rng = random.Random(2)
    table = chunked_bpe.ranks_of(RANKS)
    for n in [*range(1, 80), 300, 3000]:
        for letters in ("ab", "aethin", "a"):
            word = "".join(rng.choice(letters) for _ in range(n))
            assert table.merge(word.encode()) == ids_of(word) == library.encode_ordinary(word)


def test_known_words_are_bounded(monkeypatch):
    table = chunked_bpe.Ranks(RANKS)
    monkeypatch.setattr(chunked_bpe, "KEPT_WORDS", 100)
    for i in range(40):
        table.encode([[f"w{i}x{j}" for j in range(20)]])
        assert len(table.known) <= 100


def long_texts():
    rng = random.Random(3)
    words = ["alpha", " beta", "  gamma", "\n", "1234", "'s", "...", " é", "\t\t", "日本語"]
    return ["".join(rng.choice(words) for _ in range(400)), "a" * 700, " " * 500 + "b", ("x" * 130 + " ") * 6,
            "y" * 90 + " " * 120 + "z" * 300 + " tail" * 30, "ab " * 300, "\n" * 333, "'" * 400 + "s" * 200]


@pytest.mark.parametrize(("chunk", "overlap"), [(50, 1), (40, 8), (64, 64), (100, 30)])
def test_pieces_join_to_the_whole(spark, library, chunk, overlap):
    docs = spark.createDataFrame(list(enumerate(long_texts())), "doc_id long, text string")
    found: dict = {}
    for r in chunked_bpe.encoded(docs, RANKS, PATTERN, chunk, overlap).collect():
        found.setdefault(r.doc_id, []).append((r.at, np.frombuffer(r.ids, dtype="<u4").tolist()))
    assert len(found[0]) > 5 and len(found[1]) == 1
    for i, text in enumerate(long_texts()):
        ids = [x for _, piece in sorted(found[i]) for x in piece]
        assert ids == library.encode_ordinary(text), (i, chunk, overlap)


def expected(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        out.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_awkward_rows(spark, library):
    texts = long_texts()
    rows = [(1, None), (2, ""), (3, " "), (4, texts[0]), (4, texts[0]), (4, texts[2]), (None, texts[0]), (None, texts[3]),
            (None, None), (5, "<|endoftext|>"), (6, "\x00﻿ é"), (7, "w" * 60_000), (8, "word and " * 9000)]
    docs = spark.createDataFrame([(*r, "clash", 0, 0) for r in rows],
                                 "doc_id long, text string, tag string, at int, copies int").repartition(3)
    got = chunked_bpe.digests(docs, RANKS, PATTERN, 90, 20)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(library, rows)
    none = docs.where("false")
    assert chunked_bpe.digests(none, RANKS, PATTERN).count() == chunked_bpe.encoded(none, RANKS, PATTERN).count() == 0


def test_decoded_bytes(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["", "é 日本", "a  b\n"])], "doc_id long, text string")
    back = chunked_bpe.decoded(chunked_bpe.encoded(docs, RANKS, PATTERN), RANKS)
    assert back.join(docs, "doc_id").where(F.decode("decoded", "UTF-8") == F.col("text")).count() == 3


def test_query(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op12_chunked_bpe"](spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == expected(library, rows)
