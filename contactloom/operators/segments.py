"""Join keys for texts within a few edits of each other.

A text of length L is cut into ``limit + 1`` segments.  Of two texts within ``limit`` edits the longer one holds a
segment of the shorter one unchanged, and only near its own place: for each length difference and segment a few starts are
possible.  So the shorter text is stored under its segments, the longer one asks for those pieces of itself, and an
equality join on the hash of (length, segment number, piece) meets every pair.  At 4 edits a text has 5 stored and at most
49 asked keys, whatever its length.

Keys come one by one, for a place that a caller explodes first (``stored_key``, ``asked_key``, ``head_key``): such
code is compiled, whereas functions over arrays are interpreted.  ``stored_keys`` and ``asked_keys`` list them for one text.
Pieces of short texts are short and meet many strangers; ``unlike`` and ``misplaced`` tell most of these by numbers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters counted together in a signature; others are not counted.
CLASSES = [*"abcdefghiklmnoprstuvwy", "q0", "j1", "x2", "z3", *"456789"]
PART = 21  # bits of a set in an outline, which holds three
OUTLINED = 16  # characters of a text that has one; segments of four edits have three characters or more from 15 on
SHORT = -1  # segment number of the one key of texts too short for segments


def _segment(length: Column, number: Column, limit: int) -> tuple[Column, Column]:
    """(start from 0, length) of a segment; the last ones are longer by one where the length does not divide."""
    base = F.floor(length / (limit + 1)).cast("int")
    short = F.lit(limit + 1) - length % (limit + 1)
    return number * base + F.greatest(number - short, F.lit(0)), base + (number >= short).cast("int")


def _key(tag: Column, length: Column, number: Column, piece: Column) -> Column:
    return F.xxhash64(tag, length, number, piece)


def _short_key(tag: Column) -> Column:
    return _key(tag, F.lit(0), F.lit(SHORT), F.lit(""))


def stored_key(text: Column, length: Column, number: Column, limit: int, tag: Column) -> tuple[Column, Column]:
    """(is there one, key) of segment ``number``; a text shorter than its segments has one key of its own."""
    start, size = _segment(length, number, limit)
    key = _key(tag, length, number, F.substring(text, start + 1, size))
    return (length > limit) | (number == 0), F.when(length > limit, key).otherwise(_short_key(tag))


def _places(names: list[str], rows: list[tuple[int, ...]]) -> Column:
    """A literal array of structs, made by one expression."""
    return F.expr("array(" + ", ".join(f"named_struct({', '.join(f"'{n}', {v}" for n, v in zip(names, row))})" for row in rows) + ")")


def offsets(limit: int) -> list[tuple[int, int, int]]:
    """(length difference, segment, offset): where a longer text may hold a segment of a shorter one.

    Edits before the segment shift it by at most the segment's number, edits behind it by at most what is left.
    """
    return [
        (more, i, o)
        for more in range(limit + 1)
        for i in range(limit + 1)
        for o in range(max(-i, more - (limit - i)), min(i, more + (limit - i)) + 1)
    ]


def stored_places(limit: int) -> Column:
    return F.sequence(F.lit(0), F.lit(limit))


def asked_places(limit: int) -> Column:
    return _places(["more", "i", "o"], [*offsets(limit), (0, SHORT, 0)])


def asked_key(text: Column, whole: Column, place: Column, limit: int, tag: Column) -> tuple[Column, Column]:
    """(is there one, key) that the longer (or equally long) of two texts asks for at a place; ``whole`` is its length."""
    length = whole - place["more"]
    start, size = _segment(length, place["i"], limit)
    start = start + place["o"]
    short = place["i"] == SHORT
    fits = F.when(short, whole <= 2 * limit).otherwise((length > limit) & (start >= 0) & (start + size <= whole))
    key = _key(tag, length, place["i"], F.substring(text, start + 1, size))
    return fits, F.when(short, _short_key(tag)).otherwise(key)


def head_places(limit: int, most: int) -> Column:
    """Segments and offsets in a beginning of the text, for lengths up to ``most`` away from the expected one."""
    rows = [(t, i, o) for t in range(-most, most + 1) for i in range(limit + 1) for o in range(-i, i + 1)]
    return _places(["more", "i", "o"], [*rows, (0, SHORT, 0)])


def head_key(text: Column, expected: Column, place: Column, limit: int, tag: Column) -> tuple[Column, Column]:
    """(is there one, key) by which a text finds stored ones within ``limit`` edits of a beginning of it.

    Nothing is known of the text's end, so only edits before a segment bound its shift.
    """
    length = expected + place["more"]
    start, size = _segment(length, place["i"], limit)
    start = start + place["o"]
    short = place["i"] == SHORT
    fits = short | ((length > limit) & (start >= 0) & (start + size <= F.length(text)))
    key = _key(tag, length, place["i"], F.substring(text, start + 1, size))
    return fits, F.when(short, _short_key(tag)).otherwise(key)


def _listed(places: Column, one) -> Column:
    return F.array_distinct(F.array_compact(F.transform(places, lambda place: F.when(*one(place)))))


def stored_keys(text: Column, limit: int, tag: str) -> Column:
    """Keys under which the shorter of two texts is found."""
    return _listed(stored_places(limit), lambda number: stored_key(text, F.length(text), number, limit, F.lit(tag)))


def asked_keys(text: Column, limit: int, tag: str) -> Column:
    """Keys that the longer (or equally long) of two texts asks for."""
    return _listed(asked_places(limit), lambda place: asked_key(text, F.length(text), place, limit, F.lit(tag)))


def signature(text: Column) -> Column:
    """64 bits: for each class of characters, whether the text has one of them, and whether it has more."""
    def bits(chars: str, at: int) -> Column:
        rest = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), chars, text)
        count = F.least(F.length(text) - F.length(rest), F.lit(2))
        return F.call_function("shiftleft", F.call_function("shiftleft", F.lit(1).cast("bigint"), count) - 1, F.lit(2 * at))

    return reduce(lambda x, y: x.bitwiseOR(y), [bits(c, i) for i, c in enumerate(CLASSES)])


def unlike(s1: Column, n1: Column, s2: Column, n2: Column, limit: int) -> Column:
    """Are texts of these signatures and lengths surely more than ``limit`` edits apart?

    An edit takes a character away, adds one, or does both; each sets at most one bit of a signature, and what the lengths
    differ by is surely not both.
    """
    return F.bit_count(s1.bitwiseXOR(s2)) > F.lit(2 * limit) - F.abs(n1 - n2)


def outline(text: Column) -> Column:
    """Three sets of characters (by their codes modulo PART) in one number: the first three, the next two, the rest.

    0 for texts longer than OUTLINED, which segments tell apart.
    """
    def one(at: int) -> Column:
        part = 0 if at <= 3 else 1 if at <= 5 else 2
        code = F.ascii(F.substring(text, at, 1)) % PART
        return F.when(F.length(text) >= at, F.call_function("shiftleft", F.lit(1).cast("bigint"), code + PART * part)).otherwise(F.lit(0).cast("bigint"))

    sets = reduce(lambda x, y: x.bitwiseOR(y), [one(at) for at in range(1, OUTLINED + 1)])
    return F.when(F.length(text) <= OUTLINED, sets).otherwise(F.lit(0).cast("bigint"))


def misplaced(o1: Column, n1: Column, o2: Column, n2: Column, limit: int) -> Column:
    """Are texts of these outlines and lengths surely more than ``limit`` edits apart, as their characters stand elsewhere?

    Cut both texts behind the same number of characters.  Where the edits before the cut shift it by s, the two beginnings
    and the two ends differ in ``2 * limit + |s| - |n2 - n1 - s|`` characters at most, which is ``2 * limit + |n2 - n1|`` at most.
    """
    def sets(o: Column) -> list[Column]:
        return [F.shiftright(o, PART * i).bitwiseAND(F.lit((1 << PART) - 1)) for i in range(3)]

    (a, b, c), (x, y, z) = sets(o1), sets(o2)
    most = F.lit(2 * limit) + F.abs(n1 - n2)
    third = F.bit_count(a.bitwiseXOR(x)) + F.bit_count(b.bitwiseOR(c).bitwiseXOR(y.bitwiseOR(z)))
    fifth = F.bit_count(a.bitwiseOR(b).bitwiseXOR(x.bitwiseOR(y))) + F.bit_count(c.bitwiseXOR(z))
    return (o1 != 0) & (o2 != 0) & ((third > most) | (fifth > most))
