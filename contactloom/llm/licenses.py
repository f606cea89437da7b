"""Licence recognition by sentences.

A text is cut into sentences twice, once by lines and once with its lines joined, since licence texts
come wrapped and unwrapped.  Every normalised sentence maps to a one-letter identifier of a known licence
sentence, or to a dot.  The identifier string is matched against ordered rules: of rules that fit at one
place the first in the list wins, so complete texts stand before their single sentences.

Licence files and notices, with their titles, copyright lines and list numbers, are sought in the text as one row of words:
known sentences in sequence, with at most ``GAP`` other words between them.  What they say of BSD clauses holds, and ``all rights
reserved`` counts only where it does not lead up to such a text.

Everything is evaluated inside the row with built-in functions: no join, no shuffle, nothing to skew.

Defined cases: a null text counts as empty and gives no licence; repeated rows are judged each on its own;
further columns are not read; an empty table gives none.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.llm.common import WS, texts

# Sentences of public licence texts, lower case, words joined by one blank.
SENTENCES: list[tuple[str, str]] = [
    ("A", "licensed under the apache license version 2 0"),
    ("B", "licensed under the apache license version 2 0 the license"),
    ("C", "you may not use this file except in compliance with the license"),
    ("D", "you may obtain a copy of the license at"),
    ("E", "http www apache org licenses license 2 0"),
    ("F", "released under the mit license"),
    ("G", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
          "associated documentation files the software to deal in the software without restriction including without "
          "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the "
          "software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("H", "the above copyright notice and this permission notice shall be included in all copies or substantial "
          "portions of the software"),
    ("I", "this work is licensed under the gnu general public license version 3"),
    ("J", "this program is free software"),
    ("K", "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
          "the free software foundation"),
    ("L", "either version 3 of the license or at your option any later version"),
    ("M", "either version 2 of the license or at your option any later version"),
    ("N", "licensed under cc by nc 4 0"),
    ("O", "licensed under cc by 4 0"),
    ("P", "licensed under cc by sa 4 0"),
    ("Q", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("R", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("S", "redistribution and use in source and binary forms with or without modification are permitted provided that "
          "the following conditions are met"),
    ("T", "redistributions of source code must retain the above copyright notice this list of conditions and the "
          "following disclaimer"),
    ("U", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
          "promote products derived from this software without specific prior written permission"),
    ("V", "spdx license identifier"),
    ("W", "mit"),
    ("X", "apache 2 0"),
    ("Y", "gpl 3 0 only"),
    ("Z", "bsd 3 clause"),
    ("a", "all rights reserved"),
    ("b", "this is free and unencumbered software released into the public domain"),
]

# Ordered rules, a licence and the identifiers that stand for it, in sequence.
RULES: list[tuple[str, str]] = [
    ("Apache-2.0", "BCDE"),
    ("Apache-2.0", "BCD"),
    ("Apache-2.0", "BC"),
    ("MIT", "GH"),
    ("GPL-3.0-or-later", "JKL"),
    ("GPL-2.0-or-later", "JKM"),
    ("BSD-3-Clause", "STU"),
    ("BSD-2-Clause", "ST"),
    ("MIT", "VW"),
    ("Apache-2.0", "VX"),
    ("GPL-3.0-only", "VY"),
    ("BSD-3-Clause", "VZ"),
    ("Apache-2.0", "A"),
    ("Apache-2.0", "B"),
    ("MIT", "F"),
    ("MIT", "G"),
    ("GPL-3.0-only", "I"),
    ("GPL-3.0-or-later", "KL"),
    ("GPL-2.0-or-later", "KM"),
    ("CC-BY-NC-4.0", "N"),
    ("CC-BY-NC-4.0", "R"),
    ("CC-BY-4.0", "O"),
    ("CC-BY-4.0", "Q"),
    ("CC-BY-SA-4.0", "P"),
    ("Unlicense", "b"),
    ("All-Rights-Reserved", "a"),
]

#: What a corpus may do with a text under these licences.
RESTRICTED = ("GPL-3.0-only", "GPL-3.0-or-later", "GPL-2.0-or-later", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "All-Rights-Reserved")

#: Other words between the sentences of a full text: list numbers, for the most part.
GAP = "(?: [a-z0-9]+){0,4}? "
#: Words between ``all rights reserved`` and the licence text that it stands before.
LEAD = 30
_BY = {c: s for c, s in SENTENCES}
_HOLDER = "(?: [a-z0-9]+){1,16}?"
_BINARY = (
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
    "in the documentation and or other materials provided with the distribution"
)
_NAMES = (
    f"(?:neither the name{_HOLDER} nor the names{_HOLDER} may|the names?{_HOLDER} may not) be used to endorse or promote products derived "
    "from this software without (?:specific )?prior written permission"
)
_ADVERTISING = "all advertising materials mentioning features or use of this software must display the following acknowledge?ment(?: [a-z0-9]+){1,60}?"
_CLAUSES = _BY["S"] + GAP + _BY["T"] + GAP + _BINARY


def _gnu(kind: str, version: str, later: bool) -> str:
    terms = f"under the terms of the gnu {kind}general public license as published by the free software foundation "
    return terms + (f"either version {version} of the license or at your option any later version" if later else f"version {version} of the license")


#: Full texts: a licence, words that every such text holds, and its pattern.  Of rules with the same words the first that fits counts.
FULL: list[tuple[str, str, str]] = [
    ("BSD-4-Clause", _BY["S"], _CLAUSES + GAP + _ADVERTISING + " " + _NAMES),
    ("BSD-3-Clause", _BY["S"], _CLAUSES + GAP + _NAMES),
    ("BSD-2-Clause", _BY["S"], _CLAUSES + f"(?:{GAP}this software is provided| ?$)"),
    ("MIT", _BY["G"], _BY["G"]),
    ("Apache-2.0", _BY["A"], _BY["A"] + GAP + _BY["C"]),
    ("Apache-2.0", "terms and conditions for use reproduction and distribution", "apache license version 2 0 january 2004" + _HOLDER + " terms and conditions for use reproduction and distribution"),
    ("ISC", "permission to use copy modify and", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("MPL-2.0", "mozilla public license v 2 0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("Unlicense", _BY["b"], _BY["b"]),
] + [
    (f"{name}-{v}.{minor}-{'or-later' if later else 'only'}", f"the gnu {kind}general public license as published", _gnu(kind, f"{v}(?: {minor})?", later))
    for name, kind, v, minor in (
        ("GPL", "", 3, 0), ("GPL", "", 2, 0), ("LGPL", "lesser ", 3, 0), ("LGPL", "lesser ", 2, 1), ("AGPL", "affero ", 3, 0)
    )
    for later in (True, False)
]
#: Full texts that are restricted, beside ``RESTRICTED``.
FULL_RESTRICTED = tuple(n for n, _, _ in FULL if "GPL" in n and n not in RESTRICTED)
#: Where a full text begins.
_STARTS = "|".join([_BY["S"], _BY["G"], _BY["A"], "permission to use copy modify", "this program is free software", "this source code form is subject"])

STOPS = rf"[.!?:;]+{WS}+"


def _identifiers(sentences: Column) -> Column:
    known = F.array(*[F.lit(s) for _, s in SENTENCES])
    codes = "".join(c for c, _ in SENTENCES)
    plain = F.transform(sentences, lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")))
    spots = F.transform(F.array_remove(plain, ""), lambda s: F.array_position(known, s).cast("int"))
    letters = F.transform(spots, lambda p: F.when(p > 0, F.substring(F.lit(codes), p, F.lit(1))).otherwise(F.lit(".")))
    return F.regexp_replace(F.array_join(letters, ""), r"\.+", ".")


def _licences(identifiers: Column) -> Column:
    found = F.regexp_extract_all(identifiers, F.lit("|".join(re.escape(r) for _, r in RULES)), F.lit(0))
    pairs = [F.lit(x) for name, rule in RULES for x in (rule, name)]
    return F.transform(found, lambda m: F.element_at(F.create_map(*pairs), m))


def _full(plain: Column) -> Column:
    """Licences whose full text or notice is in a text given as words with one blank between them."""
    families: dict[str, Column] = {}
    for name, words_, pattern in reversed(FULL):
        fits = F.regexp_like(plain, F.lit(rf"\b(?:{pattern})"))
        if words_.startswith("the gnu"):  # a text may name several versions
            words_ = f"{words_}\n{name}"
        families[words_] = F.when(fits, F.lit(name)).otherwise(families.get(words_, F.lit(None)))
    found = [F.when(F.contains(plain, F.lit(w.split("\n")[0])), f) for w, f in families.items()]
    return F.array_distinct(F.array_compact(F.array(*found)))


def _ranked(single: Column, full: Column, plain: Column) -> Column:
    """Licences by sentences and by full texts, without what full texts refute."""
    told = F.exists(full, lambda n: F.startswith(n, F.lit("BSD")))
    other_bsd = F.filter(single, lambda n: ~(told & F.startswith(n, F.lit("BSD"))))
    lead = rf"\ball rights reserved(?=(?: [a-z0-9]+){{0,{LEAD}}}? (?:{_STARTS}))"
    alone = F.contains(F.regexp_replace(plain, lead, ""), F.lit(_BY["a"]))
    kept = F.filter(other_bsd, lambda n: (n != "All-Rights-Reserved") | alone)
    return F.when(F.size(full) == 0, single).otherwise(F.array_sort(F.array_union(kept, full)))


def recognise(docs: DataFrame) -> DataFrame:
    """doc_id, by_line and joined (identifier strings), licences (sorted, distinct), restricted."""
    text = F.coalesce("text", F.lit(""))
    cut = texts(docs).select(
        "doc_id",
        _identifiers(F.split(text, rf"{STOPS}|\n")).alias("by_line"),
        _identifiers(F.split(F.replace(text, F.lit("\n"), F.lit(" ")), STOPS)).alias("joined"),
        F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")).alias("_plain"),
    ).withColumn("_full", _full(F.col("_plain")))
    single = F.array_sort(F.array_union(_licences(F.col("by_line")), _licences(F.col("joined"))))
    return cut.withColumn("licences", _ranked(single, F.col("_full"), F.col("_plain"))).drop("_plain", "_full").withColumn(
        "restricted", F.arrays_overlap("licences", F.array(*[F.lit(r) for r in RESTRICTED + FULL_RESTRICTED]))
    )
