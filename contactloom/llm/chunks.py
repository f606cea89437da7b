"""Cutting a text where byte-level BPE with the usual pattern cannot merge across.

Between two characters that are not white space, a blank belongs to the match that follows it, and no
match reaches over it from the left.  Cutting before such blanks gives pieces that encode alone as they do
inside the text, and most pieces repeat, so each needs encoding once.
"""

from __future__ import annotations

import re

_RUN = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def cut(text: str) -> list[str]:
    """The first piece as it stands, every further piece without its leading blank."""
    if _RUN.search(text) or text[:1] == " " or text[-1:] == " ":
        return _CUT.split(text)
    return text.split(" ")
