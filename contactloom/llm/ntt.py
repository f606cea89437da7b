"""Exact integer convolution of many rows at once: a number-theoretic transform in float64 arithmetic.

Residues of ``PRIME`` are kept centred, so every product stays below 2^53 and is exact as a double.  ``forward`` pads
rows of ``B`` entries to ``2 B`` and gives their values at all roots of unity, in bit-reversed order.
"""

from __future__ import annotations

from functools import cache

import numpy as np

#: Prime 11 * 2^21 + 1 and a primitive root of it.
PRIME = 23068673
GENERATOR = 3
#: Longest row: roots of order 2 * MAX_ROW exist, and the lazy sums below stay exact.
MAX_ROW = 1 << 18
_TAIL = 32
_LAZY = 3


def reduce(x: np.ndarray) -> np.ndarray:
    """The centred residue, in place; exact for integers below 2^53."""
    x -= PRIME * np.rint(x * (1.0 / PRIME))
    return x


@cache
def _roots(size: int, inverse: bool) -> np.ndarray:
    """Twiddles in bit-reversed order: entry m is the root that splits block m of any level."""
    table = np.ones(1, np.int64)
    while len(table) < size:
        w = pow(GENERATOR, (PRIME - 1) // (4 * len(table)), PRIME)
        if inverse:
            w = pow(w, -1, PRIME)
        table = np.concatenate([table, table * w % PRIME])
    return np.where(table > PRIME // 2, table - PRIME, table).astype(np.float64)


@cache
def negated(size: int) -> np.ndarray:
    """Where the value at root^-f stands, for the root^f at each place."""
    order = np.zeros(1, np.int64)
    while len(order) < size:
        order = np.concatenate([2 * order, 2 * order + 1])
    place = np.empty(size, np.int64)
    place[order] = np.arange(size)
    return place[(-order) % size]


def _split(low: np.ndarray, high: np.ndarray, w: np.ndarray) -> None:
    turned = reduce(high * w)
    np.subtract(low, turned, out=high)
    low += turned


def forward(rows: np.ndarray) -> np.ndarray:
    """(R, 2 B) spectra of (R, B) rows of small integers, reduced."""
    count, width = rows.shape
    size = 2 * width
    roots = _roots(max(size // 2, 1), False)
    x = np.concatenate([rows, rows], axis=1)  # the first level of a row padded with zeros
    parts, span = 2, width
    while span > _TAIL:
        v = x.reshape(count, parts, 2, span // 2)
        _split(v[:, :, 0], v[:, :, 1], roots[None, :parts, None])
        parts, span = parts * 2, span // 2
    blocks, inner = parts, 1
    x = np.ascontiguousarray(x.reshape(count, blocks, span).transpose(2, 1, 0))
    while span > 1:
        v = x.reshape(inner, 2, span // 2, blocks, count)
        w = roots[np.arange(inner)[:, None] + inner * np.arange(blocks)[None, :]]
        _split(v[:, 0], v[:, 1], w[:, None, :, None])
        inner, span = inner * 2, span // 2
    return reduce(np.ascontiguousarray(x.transpose(2, 1, 0)).reshape(count, size))


def inverse_half(spectra: np.ndarray) -> np.ndarray:
    """The first B entries, times 2 B, of the rows with these reduced (R, 2 B) spectra; reduced."""
    count, size = spectra.shape
    roots = _roots(max(size // 2, 1), True)
    inner = min(_TAIL, size // 2)
    blocks, span, level = size // inner, 1, 0
    x = np.ascontiguousarray(spectra.reshape(count, blocks, inner).transpose(2, 1, 0))

    def join(low, high, w):
        nonlocal level
        apart = low - high
        low += high
        apart *= w
        high[...] = reduce(apart)
        level += 1
        if level % _LAZY == 0:
            low[...] = reduce(low.copy())

    while inner > 1:
        inner //= 2
        v = x.reshape(inner, 2, span, blocks, count)
        w = roots[np.arange(inner)[:, None] + inner * np.arange(blocks)[None, :]]
        join(v[:, 0], v[:, 1], w[:, None, :, None])
        span *= 2
    x = np.ascontiguousarray(x.reshape(span, blocks, count).transpose(2, 1, 0)).reshape(count, size)
    parts = blocks
    while parts > 2:
        parts //= 2
        v = x.reshape(count, parts, 2, span)
        join(v[:, :, 0], v[:, :, 1], roots[None, :parts, None])
        span *= 2
    halves = x.reshape(count, 2, size // 2)
    return reduce(halves[:, 0] + halves[:, 1])


def correlate(block: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """2 B times the inner products of rows with the window of two following rows at shifts 0 to B - 1.

    All three are spectra of ``forward``; joined rows have first + root^B * second as theirs.
    """
    half = block.shape[1] // 2
    window = np.concatenate([first[:, :half] + second[:, :half], first[:, half:] - second[:, half:]], axis=1)
    window *= block[:, negated(2 * half)]
    return inverse_half(reduce(window))
