"""Rules ledger, licences, chats and exact duplicates against plain Python, on odd inputs and on SQL."""

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from contactloom.llm import chat, exact_dedup, licenses, quality_rules
from llm_helpers import SF, WORD, clashing, odd_docs, odd_texts
from oracle_check import compare, connect


@pytest.mark.parametrize("name", ["op1_quality_rules", "op4_license_scan", "op6_chat_formatting", "op8_exact_dedup", "op9_ngram_jaccard_join"])
def test_query_matches_sql(spark, name):
    ok, _, why = compare(spark, connect(SF), SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, why


def repeat_words(ws):
    seen = collections.Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    return len({j for i in range(len(ws) - 7) if seen[tuple(ws[i : i + 8])] > 1 for j in range(i, i + 8)})


def test_measurements_match_brute_force(spark):
    docs = odd_docs(spark).where("doc_id IS NOT NULL").distinct()
    got = {r["doc_id"]: r for r in quality_rules.ledger(clashing(docs)).collect()}
    for i, text in enumerate(odd_texts()):
        t = text or ""
        ws, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        want = (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), repeat_words(ws))
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want, text


def test_ablation_counts_patterns(spark):
    entries = spark.createDataFrame([(1,), (1,), (3,), (0,), (4,)], "fail_bits bigint")
    policy = quality_rules.Policy("t", ("few_words", "repeated_windows"))
    assert policy.mask == 3
    got = {r["rule"]: (r["n_failed"], r["n_only"], r["n_dropped"]) for r in quality_rules.ablation(entries, policy).collect()}
    assert got == {"few_words": (3, 2, 3), "repeated_windows": (1, 0, 3)}
    assert [r["kept"] for r in quality_rules.apply_policy(entries, policy).collect()] == [False, False, False, True, True]


def test_empty_tables(spark):
    docs = odd_docs(spark).limit(0)
    assert quality_rules.ledger(docs).isEmpty() and licenses.recognise(docs).isEmpty()
    assert exact_dedup.decisions(docs).isEmpty() and exact_dedup.deduplicate(docs).isEmpty()
    turns = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.format_chats(chat.records(turns)).isEmpty()
    assert quality_rules.ablation(quality_rules.ledger(docs), quality_rules.STRICT).isEmpty()


def test_licences(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated\n" \
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation\n" \
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and\n" \
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n" \
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
    texts = [None, "", "words\nReleased under the MIT License.\nmore", mit, "SPDX-License-Identifier: Apache-2.0", "mit",
             "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
             "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
             "Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["licences"], r["restricted"]) for r in licenses.recognise(clashing(docs)).collect()}
    assert got[0] == got[1] == got[5] == ([], False)
    assert got[2] == (["MIT"], False) and got[3] == (["MIT"], False) and got[4] == (["Apache-2.0"], False)
    assert got[6][0] in (["GPL-3.0-or-later"], []) and got[7] == (["Apache-2.0", "CC-BY-NC-4.0"], True)


ODD_TURNS = [
    (1, 0, "user", "hi <|im_end|> \\ <|im_start|>user\nx"), (1, 1, "assistant", "\\<|[INST] </s>"), (1, 2, "assistant", ""),
    (2, None, None, None), (2, 5, "tool\n<|x|>", "é🙂\n\n"), (2, 5, "assistant", "b"), (2, 5, "assistant", "a"), (2, 5, "assistant", "a"),
    (None, 0, "user", "lost"), (3, 0, "user", "q"), (3, 1, "assistant", "r" * 50000), (4, 0, "system", "s"), (4, 1, "assistant", "t\0u"),
]


def test_chats_read_back(spark):
    turns = spark.createDataFrame(ODD_TURNS, "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: r for r in chat.format_chats(chat.records(clashing(turns))).collect()}
    want = collections.defaultdict(list)
    for c, n, role, text in sorted(ODD_TURNS, key=lambda r: (r[0] or -1, -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want[c].append((role or "", text or ""))
    assert set(got) == set(want)
    for c, list_ in want.items():
        assert [tuple(t) for t in got[c]["read_turns"]] == list_
        assert got[c]["loss_text"] == "".join(t for r, t in list_ if r == "assistant")
        spans = [got[c]["formatted"][s["start"] : s["end"]] for s in got[c]["loss_spans"]]
        assert len(spans) == sum(r == "assistant" for r, _ in list_)
    assert {got[3]["layout"], got[4]["layout"], got[2]["layout"]} == {"prompt_response", "conversations", "messages"}


def test_layouts_by_fingerprint(spark):
    raws = [
        '{"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "assistant"}]}',
        '{"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}',
        '{"response": "b", "prompt": "a"}', '{"output": "b", "instruction": "a"}', '{"prompt": 1, "response": null}',
        '{"other": 1}', "not json", None,
    ]
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    got = [(r["layout"], [tuple(t) for t in r["turns"]] if r["turns"] is not None else None) for r in chat.canonical_turns(df).collect()]
    pair = [("user", "a"), ("assistant", "b")]
    assert got[:4] == [("messages", pair), ("conversations", pair), ("prompt_response", pair), ("instruction_output", pair)]
    assert got[4] == ("prompt_response", [("user", "1"), ("assistant", "")])
    assert got[5:] == [("unknown", None)] * 3


def digest(t):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()


def test_exact_decisions_match_brute_force(spark):
    docs = odd_docs(spark)
    given = [(r["doc_id"], digest(r["text"])) for r in docs.collect()]
    got = exact_dedup.decisions(clashing(docs)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text_sha256"]) for r in got) == sorted((d is None, d or 0, h) for d, h in given)
    for r in got:
        same = [d for d, h in given if h == r["text_sha256"]]
        ids = [d for d in same if d is not None]
        assert r["group_size"] == len(same) and r["keep_id"] == (min(ids) if ids else None)
    kept = collections.Counter(r["text_sha256"] for r in got if r["kept"])
    assert kept == collections.Counter({h for _, h in given})


def test_exact_deduplicate_keeps_columns(spark):
    docs = clashing(odd_docs(spark))
    out = exact_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    got = [(r["doc_id"], digest(r["text"])) for r in out.collect()]
    assert sorted(h for _, h in got) == sorted({digest(r["text"]) for r in docs.collect()})
    assert (7, digest(odd_texts()[7])) in got and (8, digest(odd_texts()[8])) not in got


@pytest.mark.parametrize("bits", [1 << 16, 1])
def test_filter_of_any_size_misses_no_copy(spark, bits):
    keys = spark.range(3000).select((F.col("id") % 2900).cast("string").alias("k"))
    maps = exact_dedup.repeat_filter(keys, "k", bits)
    tested = exact_dedup.maybe_repeated(keys, "k", maps, bits, "again")
    copies = tested.where(F.col("k").cast("int") < 100)
    assert copies.count() == 200 and copies.where("NOT again").isEmpty()
    assert bits == 1 or tested.where("again").count() < 500


MIT_FILE = """MIT License

Copyright (c) 2020 Jane Roe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD_HEAD = """Copyright (c) 2020, Jane Roe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

"""
BSD_CLAUSES = [
    "Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n",
    "Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n"
    "   and/or other materials provided with the distribution.\n\n",
    "Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n"
    "   this software without specific prior written permission.\n\n",
]
BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"\nAND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.\n'
GPL_NOTICE = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version {} of the License, or
    (at your option) any later version.
"""


def test_verbatim_licence_files(spark):
    numbered = lambda n: BSD_HEAD + "".join(f"{i + 1}. {c}" for i, c in enumerate(BSD_CLAUSES[:n])) + BSD_END
    bulleted = lambda n: BSD_HEAD + "".join(f"* {c}" for c in BSD_CLAUSES[:n]) + BSD_END
    comment = "".join(f" * {line}\n" for line in MIT_FILE.splitlines())
    cases = [
        (MIT_FILE, ["MIT"], False), (MIT_FILE.replace("\n\n", "\n"), ["MIT"], False), ("/*\n" + comment + " */\nint x;", ["MIT"], False),
        (numbered(2), ["BSD-2-Clause"], False), (numbered(3), ["BSD-3-Clause"], False),
        (bulleted(2), ["BSD-2-Clause"], False), (bulleted(3), ["BSD-3-Clause"], False),
        (GPL_NOTICE.format(3), ["GPL-3.0-or-later"], True), (GPL_NOTICE.format(2), ["GPL-2.0-or-later"], True),
        (numbered(3) + "\n" + "word " * 40 + "\nOther part: all rights reserved.\n", ["All-Rights-Reserved", "BSD-3-Clause"], True),
        ("(c) 2020 Jane Roe\nAll rights reserved.\n", ["All-Rights-Reserved"], True),
    ]
    docs = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "doc_id bigint, text string")
    for r in licenses.recognise(clashing(docs)).collect():
        assert (r["licences"], r["restricted"]) == cases[r["doc_id"]][1:], cases[r["doc_id"]][0]
