"""Licences recognised from their sentences, in the manner of sentence rules.

Comment marks go and a text is cut into sentences at full stops and blank lines, not at the
ends of wrapped lines. Each is normalised to lower-case words, and known sentences in it, which
end with a sentence or a line, become identifiers. The sequence of identifiers is matched
against licence rules: a rule holds if its identifiers occur in that order, others between
them allowed; rules are tried in order and a rule that another, more specific one includes
does not count beside it. SPDX expressions give their own ids.

All in column expressions, nothing shuffles. Null and empty texts have no sentences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborloom.llm.shared import text_or_empty

_FREE = r"is free software you can redistribute it and or modify it under the terms (and conditions )?of "
_BY = r" as published by the free software foundation"
#: Well-known sentences of public licences, normalised, as identifier → pattern.
#: A space also matches a line end. What follows must be the end of a line or sentence, except
#: behind a pattern that ends with an ellipsis.
SENTENCES = {
    "apacheNotice": r"(licensed|licenses this \w+ to you) under the apache license version 2(\.0)?( the license)?",
    "apacheComply": r"you may not use this file except in compliance with the license",
    "apacheAsIs": r"unless required by applicable law or agreed to in writing software distributed under the "
                  r"license is distributed on an as is basis without warranties or conditions of any kind…",
    "apacheTitle": r"apache license version 2\.0 january 2004",
    "apacheGrant": r"subject to the terms and conditions of this license each contributor hereby grants to you a perpetual "
                   r"worldwide non exclusive no charge royalty free irrevocable (copyright|except as stated in this section "
                   r"patent) license…",
    "mitNotice": r"(released|licensed|distributed) under the (terms of the )?mit license",
    "mitGrant": r"permission is hereby granted free of charge to any person obtaining a copy of this software…",
    "mitNoticeKept": r"the above copyright notice and this permission notice shall be included in all copies…",
    "bsdNotice": r"(released|licensed|distributed) under the (terms of the )?(new |simplified )?bsd license",
    "bsdGrant": r"redistribution and use in source and binary forms with or without modification are permitted…",
    "bsdNoName": r"neither the names? of (?:(?! may be used to |neither the ).)*+ may be used to endorse or promote products…|"
                 r"the names? of (?:(?! may not be used to | the names? of ).)*+ may not be used to endorse or promote products…",
    "iscGrant": r"permission to use copy modify and( or)? distribute this software for any purpose with or without fee is "
                r"hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "zeroBsdGrant": r"permission to use copy modify and( or)? distribute this software for any purpose with or without fee "
                    r"is hereby granted",
    "disclaims": r"the software is provided as is and (the authors?|isc) disclaims? all warranties with regard to this software…",
    "zlibAsIs": r"this software is provided as is without any express or implied warranty",
    "zlibGrant": r"permission is granted to anyone to use this software for any purpose including commercial applications "
                 r"and to alter it and redistribute it freely…",
    "boostNotice": r"(released|licensed|distributed) under the boost software license version 1\.0",
    "boostGrant": r"permission is hereby granted free of charge to any person or organization obtaining a copy of the "
                  r"software and accompanying documentation covered by this license…",
    "unlicensed": r"this is free and unencumbered software released into the public domain",
    "cc0Notice": r"licensed under (a )?(cc0|cc 0) 1\.0( universal)?",
    "cc0Waived": r"has waived all copyright and related or neighboring rights…",
    "epl1Notice": r"made available under the terms of the eclipse public license (v |version )?1\.0…",
    "epl2Notice": r"made available under the terms of the eclipse public license (v |version )?2\.0…",
    "ccByNc4": r"licensed under (a )?cc by nc 4\.0",
    "ccBySa4": r"licensed under (a )?cc by sa 4\.0",
    "ccBy4": r"licensed under (a )?cc by 4\.0",
    "gplNotice3": r"(released|licensed) under the gnu general public license (version |v )3(\.0)?(?= or (at your option )?any later )…|"
                  r"(released|licensed) under the gnu general public license (version |v )3(\.0)?",
    "gplNotice2": r"(released|licensed) under the gnu general public license (version |v )2(\.0)?(?= or (at your option )?any later )…|"
                  r"(released|licensed) under the gnu general public license (version |v )2(\.0)?",
    "lgplNotice": r"(released|licensed) under the gnu lesser general public license…",
    "gplFree2": _FREE + rf"(version 2 of the gnu general public license|the gnu general public license (version |v )2(\.0)?){_BY}…",
    "gplFree3": _FREE + rf"(version 3 of the gnu general public license|the gnu general public license (version |v )3(\.0)?){_BY}…",
    "gplFree": _FREE + rf"the gnu general public license{_BY}…",
    "lgplFree": _FREE + rf"the gnu (lesser|library) general public license{_BY}…",
    "agplFree": _FREE + rf"the gnu affero general public license{_BY}…",
    "version21": r"either version 2\.1…|version 2\.1 of the license…",
    "version2": r"either version 2(\.0)?…|version 2 of the license…",
    "version3": r"either version 3(\.0)?…|version 3(\.0)? of the license…",
    "gplOrLater": r"or (at your option )?any later version",
    "mplNotice": r"this source code form is subject to the terms of the mozilla public license v 2\.0",
    "mplTitle": r"mozilla public license version 2\.0",
    "mplAsIs": r"covered software is provided under this license on an as is basis without warranty of any kind…",
    "spdx": r"spdx license identifier[\x20][a-z0-9.+\x20]+",
    "asIs": r"the software is provided as is without warranty of any kind…",
    "allRights": r"all rights reserved",
}
_LATER = "(?!,gplOrLater,)"
#: Licence rules in the order in which they are tried. Identifiers joined by a
#: comma have to be neighbours, as the version belongs to the notice before it.
RULES = [
    ("Apache-2.0", ["apacheNotice", "apacheComply", "apacheAsIs"]),
    ("Apache-2.0", ["apacheNotice"]),
    ("Apache-2.0", ["apacheTitle", "apacheGrant"]),
    ("MIT", ["mitGrant", "mitNoticeKept", "asIs"]),
    ("MIT", ["mitNotice"]),
    ("BSD-3-Clause", ["bsdGrant", "bsdNoName"]),
    ("BSD-2-Clause", ["bsdGrant"]),
    ("BSD", ["bsdNotice"]),
    ("CC-BY-NC-4.0", ["ccByNc4"]),
    ("CC-BY-SA-4.0", ["ccBySa4"]),
    ("CC-BY-4.0", ["ccBy4"]),
    ("GPL-3.0-or-later", ["(?:gplFree,version3|gplFree3|gplNotice3),gplOrLater"]),
    ("GPL-3.0-only", [f"(?:gplFree,version3|gplFree3){_LATER}"]),
    ("GPL-2.0-or-later", ["(?:gplFree,version2|gplFree2|gplNotice2),gplOrLater"]),
    ("GPL-2.0-only", [f"(?:gplFree,version2|gplFree2){_LATER}"]),
    ("GPL", ["gplFree(?!,version[23],)"]),
    ("GPL-3.0", [f"gplNotice3{_LATER}"]),
    ("GPL-2.0", [f"gplNotice2{_LATER}"]),
    *((f"{family}-{number}-{kind}", [f"{notice},{version}{then}"])
      for family, notice, numbers in (
          ("LGPL", "lgplFree", {"2.0": "version2", "2.1": "version21", "3.0": "version3"}),
          ("AGPL", "agplFree", {"3.0": "version3"}))
      for number, version in numbers.items()
      for kind, then in (("or-later", ",gplOrLater"), ("only", _LATER))),
    ("LGPL", ["(?:lgplNotice|lgplFree(?!,version))"]),
    ("AGPL", ["agplFree(?!,version)"]),
    ("MPL-2.0", ["mplNotice"]),
    ("MPL-2.0", ["mplTitle", "mplAsIs"]),
    ("ISC", ["iscGrant", "disclaims"]),
    ("0BSD", ["zeroBsdGrant", "disclaims"]),
    ("Zlib", ["zlibAsIs", "zlibGrant"]),
    ("BSL-1.0", ["boostGrant", "asIs"]),
    ("BSL-1.0", ["boostNotice"]),
    ("Unlicense", ["unlicensed"]),
    ("CC0-1.0", ["(?:cc0Notice|cc0Waived)"]),
    ("EPL-1.0", ["epl1Notice"]),
    ("EPL-2.0", ["epl2Notice"]),
]
#: A rule counts only where none of these, which include it, holds.
INCLUDED_IN = {"BSD-2-Clause": "BSD-3-Clause"}
#: Every known sentence has one of these words, so a text without them needs no cutting.
ANCHORS = ["licen", "permission", "redistribut", "reserved", "warrant", "later", "endorse", "unencumbered", "waived"]
#: Marks of comments and quotations at the start of a line.
MARKS = r"(?m)^[#*/;%!<>|'\"\t -]*+(?:(?:dnl|DNL|rem|REM|\.\\\")(?=\s|$)[\t ]*+|[cC](?=[\t ]{2}))?"
#: Full stops that end no sentence: of abbreviated versions and of company forms.
ABBREVIATED = r"\b([vV]|[vV]ers?|[nN]o)\.(?=\s*+\d)|\b(Inc|INC|Ltd|LTD|Corp|CORP|Co|CO)\.(?=,|\s++\p{Ll})"
#: Spelling of SPDX ids, which are case-insensitive.
SPDX_NAMES = {name.lower(): name for name in (name for name, _ in RULES)} | {
    f"{f.lower()}-{v}+": f"{f}-{v}-or-later" for f in ("GPL", "LGPL", "AGPL") for v in ("2.0", "2.1", "3.0")}
_ID = r"[A-Za-z0-9.+:-]+"


def _pattern(known: str) -> str:
    """A sentence's pattern with line ends for spaces and the ends it may have."""
    ends = [p[:-1] + "(?= |$)" if p.endswith("…") else p + r"(?=\n|$)" for p in _alternatives(known)]
    return "(?:" + "|".join(ends).replace(" ", r"[ \n]") + ")"


def _alternatives(known: str) -> list[str]:
    """Parts between the bars outside brackets."""
    parts, depth = [""], 0
    for c in known:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            parts.append("")
        else:
            parts[-1] += c
    return parts


def normalised(sentence: Column) -> Column:
    """Lower-case words, digits and version dots, one space or line feed between.

    A line feed stands where a line or, with a semicolon, a part of the sentence ends.
    """
    plain = F.regexp_replace(F.lower(sentence), r"\bv(?=\d)", "v ")
    plain = F.regexp_replace(plain, r";(?![\p{L}\p{N}])", "\n")
    plain = F.regexp_replace(
        plain, r"[^\p{L}\p{N}.+\n -]+|(?<!\d)\.|\.(?!\d)|(?<![a-z])-|-(?![a-z])", " ")
    plain = F.regexp_replace(F.replace(plain, F.lit("-"), F.lit(" ")), r"[^\S\n]+", " ")
    return F.regexp_replace(F.regexp_replace(plain, r" ?\n[ \n]*+", "\n"), r"^[ \n]++|(?<![ \n])[ \n]++$", "")


def sentences(text: Column) -> Column:
    """Array of normalised sentences; they end at blank lines and at .!? before white space."""
    anchored = F.lower(text).rlike("|".join(ANCHORS))
    lines = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), MARKS, "")
    cut = F.split(F.regexp_replace(lines, ABBREVIATED, "$1$2"), r"[.!?]+(?=\s|$|[^\w\s])|\n[^\S\n]*+\n")
    some = F.filter(cut, lambda s: F.lower(s).rlike("|".join(ANCHORS)))
    return F.when(anchored, F.transform(some, normalised)).otherwise(F.array().cast("array<string>"))


def identified(cut: Column) -> Column:
    """Identifiers of the known sentences, in order; a sentence may hold several."""
    patterns = {name: _pattern(known) for name, known in SENTENCES.items()}
    every = r"(?s)(?<![^ \n])(?:" + "|".join(patterns.values()) + ")"

    def known(found: Column) -> Column:
        # What follows a match is no part of it, so that its last look ahead sees an end.
        chosen = F.lit(None).cast("string")
        for name, pattern in reversed(patterns.items()):
            chosen = F.when(found.rlike(f"(?s)^{pattern}"), F.lit(name)).otherwise(chosen)
        return chosen

    return F.transform(F.flatten(F.transform(cut, lambda s: F.regexp_extract_all(s, F.lit(every), F.lit(0)))), known)


def spdx_ids(text: Column) -> Column:
    """Licence ids of the SPDX expressions, in order; exceptions are no licences."""
    lead = r"(?i)\bspdx[- ]license[- ]identifier[:\t ]*+"
    more = rf"(?:[\t )]++(?:and|or|with)[\t (]++{_ID})*+"
    lines = F.regexp_extract_all(text, F.lit(rf"{lead}\(*+({_ID}{more})"), F.lit(1))
    parts = F.flatten(F.transform(lines, lambda s: F.regexp_extract_all(
        s, F.lit(rf"(?i)\b(?:and|or|with[\t (]++{_ID})(?=[\t )(]|$)|({_ID})"), F.lit(1))))
    plain = F.transform(parts, lambda s: F.regexp_replace(s, r"(?<![.:])[.:]++$", ""))
    some = F.filter(plain, lambda s: ~F.upper(s).isin("", "NONE", "NOASSERTION"))
    names = F.create_map(*[F.lit(x) for pair in SPDX_NAMES.items() for x in pair])
    return F.transform(some, lambda s: F.coalesce(F.try_element_at(names, F.lower(s)), s))


def _in_order(parts: list[str]) -> str:
    """Pattern of a line of identifiers in which the parts occur in their order.

    Each part is taken where it comes first behind the one before and is not looked for again,
    which decides alike and takes one pass over the line.
    """
    first, *rest = parts
    return f"^(?>.*?,{first},)" + "".join(f"(?>(?:.*?,)??{part},)" for part in rest)


def licences(sequence: Column, text: Column) -> Column:
    """Names of the licences whose rules hold, in the order of RULES, then further SPDX ids."""
    line = F.concat(F.lit(","), F.array_join(sequence, ","), F.lit(","))
    holds: dict[str, Column] = {}
    for name, names in RULES:
        rule = line.rlike(_in_order(names))
        holds[name] = holds[name] | rule if name in holds else rule
    for name, wider in INCLUDED_IN.items():
        holds[name] = holds[name] & ~holds[wider]
    ruled = F.filter(F.array(*[F.when(held, F.lit(name)) for name, held in holds.items()]), lambda s: s.isNotNull())
    spdx = F.when(F.array_contains(sequence, "spdx"), spdx_ids(text)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(ruled, spdx))


def scanned(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, sentence_ids (array in order), licences (array)."""
    found = docs.select("doc_id", text_or_empty().alias("text"), identified(sentences(text_or_empty())).alias("sentence_ids"))
    return found.select("doc_id", "sentence_ids", F.when(F.size("sentence_ids") > 0, licences(F.col("sentence_ids"), F.col("text")))
                        .otherwise(F.array().cast("array<string>")).alias("licences"))
