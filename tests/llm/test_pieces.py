"""Encoded pieces are kept from block to block."""

from __future__ import annotations

import public_tokenizers as P

from contactloom.llm import bpe


def test_pieces_of_earlier_blocks_are_not_cut_again():
    own = bpe.Engine(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    texts, asked, find = ["one two-three 4,5", "", " a  b", "x two-three"], [], own.find
    own.find = lambda p: asked.append(p) or find(p)
    first = list(own.encode(texts))
    assert " two-three" in asked
    asked.clear()
    assert list(own.encode(texts)) == first and " two-three" not in asked
    own.pieces.clear()
    assert list(own.encode(texts)) == first
