"""BPE and packing against the tokenizer libraries."""

import base64
import collections
import hashlib
import struct
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from contactloom.llm import bpe, packing
from contactloom.llm.chunks import cut
from llm_helpers import clashing, odd_docs, odd_texts

RANKS, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(JSON)


LONG = ["a" * 5000, "ab" * 700 + "c", "the" * 400, "日本" * 300, "xyzzyplugh" * 60, "é" * 400, " " * 900, "1234567890" * 90, "!?" * 500]


END = "<|endoftext|>"


@pytest.mark.parametrize("text", [f"a {END} b", END, END * 3, f"{END} x", f"x {END}", f"a{END}b  {END}\n\n c", END[:-1], f"<{END}>", f" {END} ", "the <|endoftext |> no"])
def test_added_tokens_are_single_ids(tokenizer, text):
    own = packing.Tokens(JSON, P.PATTERN)
    assert own.ids(text).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_encoding_is_the_library_s(library):
    own = bpe.Engine(RANKS, P.PATTERN)
    block = [t or "" for t in odd_texts()] + LONG
    for text, (n, ids, back) in zip(block, own.encode(block)):
        want = library.encode_ordinary(text)
        assert (n, ",".join(ids)) == (len(want), ",".join(map(str, want))), text[:40]
        assert b"".join(back) == text.encode()


def test_long_rule_equals_single_contractions(library):
    own = bpe.Engine(RANKS, P.PATTERN)
    words = [w for t in odd_texts() + LONG for w in own.find((t or "")[:1500])]
    own._encode(bpe.CONTRACT_LONG, list(dict.fromkeys(words)))
    for w in words:
        assert own.ids[own.place[w]] == ",".join(map(str, library.encode_ordinary(w)))


def test_round_trip_and_decode(spark, library):
    docs = clashing(odd_docs(spark))
    got = collections.Counter(tuple(r) for r in bpe.round_trip(docs, RANKS, P.PATTERN).collect())
    want = collections.Counter()
    for r in docs.collect():
        ids = library.encode_ordinary(r["text"] or "")
        want[r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()] += 1
    assert got == want
    ids = bpe.encode(docs.where("doc_id IS NOT NULL"), RANKS, P.PATTERN)
    for r in bpe.decode(ids, RANKS).collect():
        assert bytes(r["decoded"]).decode() == (odd_texts()[r["doc_id"]] or "")
    assert bpe.round_trip(docs.limit(0), RANKS, P.PATTERN).isEmpty()


def test_cuts_are_where_no_match_reaches_over(library):
    for text in odd_texts() + LONG:
        if text:
            first, *rest = cut(text)
            parts = [first] + [" " + p for p in rest]
            assert "".join(parts) == text
            assert [i for p in parts for i in library.encode_ordinary(p)] == library.encode_ordinary(text)


def check_packing(rows, want):
    """rows as of ``pack``; want: list of id lists, one for each document row."""
    sequences, starts = collections.defaultdict(list), collections.Counter()
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        starts[r["doc_id"], r["start"] == 0] += r["start"] == 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= packing.WINDOW
    assert sum(r["length"] for r in rows) == sum(map(len, want))
    return sequences


def test_every_id_lies_in_one_piece(spark, tokenizer):
    docs = clashing(odd_docs(spark))
    given = [(r["doc_id"], tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]) for r in docs.collect()]
    rows = packing.pack(docs, JSON, P.PATTERN).collect()
    check_packing(rows, [ids for _, ids in given])
    unique = {d: ids for d, ids in given if d is not None and d != 7}
    covered = collections.Counter()
    for r in rows:
        if r["doc_id"] in unique:
            ids = unique[r["doc_id"]]
            piece = ids[r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(piece)}I", *piece)) and r["doc_tokens"] == len(ids)
            covered[r["doc_id"]] += len(piece)
    assert covered == {d: len(ids) for d, ids in unique.items()}
    assert packing.pack(docs.limit(0), JSON, P.PATTERN).isEmpty()


def test_neighbours_are_bm25_order():
    rng = np.random.default_rng(3)
    tails = [rng.integers(0, 60, rng.integers(1, 90)).astype(np.uint16) for _ in range(30)]
    df = np.zeros(1 << 16, np.int64)
    for t in tails:
        df[np.unique(t)] += 1
    idf, mean = np.log(1 + (30 - df + 0.5) / (df + 0.5)), float(np.mean([len(t) for t in tails]))
    unused = np.ones(30, bool)
    unused[[0, 4]] = False
    got = packing.Index(tails, idf, mean).neighbours(0, unused)
    score = []
    for t in tails:
        tf = collections.Counter(t.tolist())
        score.append(sum(idf[q] * tf[q] * 2.2 / (tf[q] + 1.2 * (0.25 + 0.75 * len(t) / mean)) for q in set(tails[0].tolist()) if q in tf))
    assert got.tolist() == sorted((i for i in range(30) if unused[i]), key=lambda i: (-round(score[i], 9), i))


def test_only_the_last_sequence_of_a_shard_is_short():
    rng = np.random.default_rng(4)
    tails = [rng.integers(2, 500, rng.integers(1, 2047)).astype(np.uint16) for _ in range(60)]
    sequences = packing.fill(tails, np.ones(1 << 16), 900.0)
    used = collections.defaultdict(list)
    for s in sequences:
        for t, a, b in s:
            used[t].append((a, b))
    for t, parts in used.items():
        assert [x for p in sorted(parts) for x in range(*p)] == list(range(len(tails[t])))
    assert all(sum(b - a for _, a, b in s) == packing.WINDOW for s in sequences[:-1])
