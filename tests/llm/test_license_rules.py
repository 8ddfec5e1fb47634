"""Ordered licence rules against a plain search, and on long sequences of identifiers."""

from __future__ import annotations

import random
import re
import time

import duckdb
import regex
from pyspark.sql import functions as F

from laborloom.llm import license_scan as ls


def plain(line: str, parts: list[str]) -> bool:
    """Some choice of places for all the parts, by trying every one."""
    def place(start: int, left: list[str]) -> bool:
        return not left or any(place(m.end() - 1, left[1:]) for m in re.finditer(f",{left[0]}(?=,)", line[start:])
                               for m in [re.compile(f",{left[0]},").match(line, start + m.start())] if m)
    return place(0, parts)


def test_rules_against_every_choice_of_places(spark):
    rng = random.Random(7)
    names = sorted({n for _, parts in ls.RULES for p in parts for n in re.findall(r"[a-zA-Z]+\w*", p) if n in ls.SENTENCES})
    names += [f"{free},{version}{later}" for free in ("gplFree", "lgplFree", "agplFree")
              for version in ("version2", "version21", "version3") for later in ("", ",gplOrLater")]
    names += ["mitGrant", "mitNoticeKept", "asIs", "apacheNotice", "apacheComply", "apacheAsIs", "bsdGrant", "bsdNoName"] * 4
    lines = ["," + ",".join(rng.choice(names) for _ in range(rng.randint(0, 9))) + "," for _ in range(2500)]
    frame = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "id long, line string").repartition(4)
    rules = [parts for _, parts in ls.RULES]
    held = frame.select("id", *[F.col("line").rlike(ls._in_order(parts)).alias(f"r{k}") for k, parts in enumerate(rules)]).collect()
    for row in held:
        for k, parts in enumerate(rules):
            assert row[f"r{k}"] == plain(lines[row.id], parts), (lines[row.id], parts)
    assert all(any(row[f"r{k}"] for row in held) for k in range(len(rules)))


def test_repeated_sentences_take_seconds(spark):
    grant = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.\n\n"
    kept = "The above copyright notice and this permission notice shall be included in all copies.\n\n"
    rows = [(1, grant * 1500 + kept * 1500), (2, (grant + kept) * 1000 + "The software is provided \"as is\", without warranty of any kind.")]
    start = time.perf_counter()
    found = {r.doc_id: (len(r.sentence_ids), r.licences) for r in
             ls.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: (3000, []), 2: (2001, ["MIT"])}
    many = spark.range(1).select(F.array_repeat(F.lit("mitGrant"), 50_000).alias("a"), F.array_repeat(F.lit("mitNoticeKept"), 50_000).alias("b"))
    assert many.select(ls.licences(F.concat("a", "b"), F.lit("")).alias("names")).first().names == []
    assert time.perf_counter() - start < 30


#: Openings and disclaimers as published, wrapped as they are there.
PUBLISHED = {
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS.""",
    "Zlib": """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED.""",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC0-1.0": """To the extent possible under law, the author has waived all copyright
and related or neighboring rights to this work.""",
    "EPL-2.0": """ * This program and the accompanying materials are made available under the
 * terms of the Eclipse Public License 2.0 which is available at
 * https://www.eclipse.org/legal/epl-2.0/""",
    "EPL-1.0": """// This program and the accompanying materials
// are made available under the terms of the Eclipse Public License v1.0
// which accompanies this distribution.""",
    "Apache-2.0": """                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   2. Grant of Copyright License. Subject to the terms and conditions of
      this License, each Contributor hereby grants to You a perpetual,
      worldwide, non-exclusive, no-charge, royalty-free, irrevocable
      copyright license to reproduce, prepare Derivative Works of.""",
    "MPL-2.0": """Mozilla Public License Version 2.0
==================================

Covered Software is provided under this License on an "as is" basis,
without warranty of any kind, either expressed, implied, or statutory.""",
}


def test_published_texts(spark):
    comment = lambda text: "\n".join(f"# {line}" for line in text.splitlines())
    rows = [(f"{name} {i}", form(text)) for name, text in PUBLISHED.items()
            for i, form in enumerate([str, comment, lambda t: t.replace("\n", "\r\n"), lambda t: "def f():\n    pass\n\n" + t + "\n\nMore."])]
    got = {r.doc_id: r.licences for r in ls.scanned(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {key: [key.split()[0]] for key, _ in rows}
    # Half of a text is no licence where its rule asks for more.
    halves = [(name, PUBLISHED[name].split("\n\n")[0]) for name in ("ISC", "0BSD", "Zlib", "BSL-1.0", "Apache-2.0", "MPL-2.0")]
    assert not any(r.licences for r in ls.scanned(spark.createDataFrame(halves, "doc_id string, text string")).collect())


def by_hand(text):
    """Identifiers and rules by trying every known sentence at every word, without the column expressions."""
    known = {name: regex.compile(ls._pattern(p), regex.S) for name, p in ls.SENTENCES.items()}
    text = regex.sub(ls.MARKS, "", regex.sub(r"\r\n?", "\n", text), flags=regex.A)
    text = regex.sub(ls.ABBREVIATED, r"\1\2", text)
    ids = []
    for sentence in regex.split(r"[.!?]+(?=\s|$|[^\w\s])|\n[^\S\n]*\n", text, flags=regex.A):
        words = regex.sub(r"\bv(?=\d)", "v ", sentence.lower())
        words = regex.sub(r";(?![\p{L}\p{N}])", "\n", words)
        words = regex.sub(r"[^\p{L}\p{N}.+\n -]+|(?<!\d)\.|\.(?!\d)", " ", words).replace("-", " ")
        words = "\n".join(" ".join(line.split()) for line in words.split("\n") if line.split())
        place = 0
        for start in [m.start() for m in regex.finditer(r"(?<![^ \n])[^ \n]", words)]:
            if start >= place and (hit := next(((n, m) for n, p in known.items() if (m := p.match(words, start))), None)):
                ids.append(hit[0])
                place = hit[1].end()
    return ids, {name for name, parts in ls.RULES if plain("," + ",".join(ids) + ",", parts)}


def test_whole_table_by_hand(spark, sf_dir="/root/testdata/sf0.01"):
    texts = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{sf_dir}/documents.parquet'").fetchall()
    got = {r.doc_id: r for r in ls.scanned(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()}
    assert len(got) == len(texts)
    for doc_id, text in texts:
        ids, names = by_hand(text)
        names -= {small for small, wide in ls.INCLUDED_IN.items() if wide in names}
        assert got[doc_id].sentence_ids == ids, doc_id
        assert {n for n in got[doc_id].licences if "spdx" not in ids or n in names} >= names, doc_id
        assert "spdx" in ids or set(got[doc_id].licences) == names, doc_id
    assert sum(bool(r.licences) for r in got.values()) > 10
