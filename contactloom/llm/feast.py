"""Leading eigenpairs of a symmetric matrix by contour integration, checked by inertia counts.

The spectrum above a cut is sliced into intervals by the inertia of shifted matrices (signs of an L D L^T
factorisation).  In each interval a block of vectors is projected by quadrature of complex shifted solves along a circle
through the ends, and Rayleigh-Ritz extracts the pairs; this repeats until every pair of the interval has converged and
their number is the one that the inertia counts demand.  A block that stalls is widened, up to the whole space, where
Rayleigh-Ritz is exact; so it ends for any spectrum, repeated eigenvalues included.
"""

from __future__ import annotations

import numpy as np

#: Gauss-Legendre points on the upper half circle; relative residual of an accepted pair.
POINTS, RESIDUAL = 8, 1e-13
#: Pairs per interval, above which it is cut again.
PER_INTERVAL = 8


def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are above ``shift``: positive pivots of L D L^T with symmetric pivoting."""
    a = matrix - shift * np.eye(len(matrix))
    alpha, positive = (1 + 17**0.5) / 8, 0
    while len(a):
        n = len(a)
        diagonal = np.abs(np.diag(a))
        i = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        r, s = divmod(int(off.argmax()), n)
        if diagonal[i] == 0 and off[r, s] == 0:
            return positive
        if diagonal[i] >= alpha * off[r, s]:
            positive += bool(a[i, i] > 0)
            rest = np.delete(np.arange(n), i)
            a = a[np.ix_(rest, rest)] - np.outer(a[rest, i], a[i, rest] / a[i, i])
        else:  # a 2 x 2 pivot has one positive and one negative eigenvalue
            positive += 1
            rest = np.delete(np.arange(n), [r, s])
            pivot = a[np.ix_([r, s], [r, s])]
            a = a[np.ix_(rest, rest)] - a[np.ix_(rest, [r, s])] @ np.linalg.solve(pivot, a[np.ix_([r, s], rest)])
    return positive


def intervals(matrix: np.ndarray, wanted: int, per: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues in it) from the top down, until they hold ``wanted`` eigenvalues at least.

    Intervals are halved until they hold ``per`` at most or are as narrow as rounding allows.
    """
    bound = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-9)
    todo, out, held = [(-bound, bound, len(matrix), 0)], [], 0
    while todo and held < wanted:
        low, high, above_low, above_high = todo.pop()
        number = above_low - above_high
        if number == 0:
            continue
        middle = (low + high) / 2
        if number <= per or high - low <= 1e-10 * bound:
            out.append((low, high, number))
            held += number
            continue
        above = inertia(matrix, middle)
        todo += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return out


def project(matrix: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block under the spectral projector of (low, high): quadrature of shifted solves."""
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    eye, total = np.eye(len(matrix)), np.zeros_like(block)
    for x, w in zip(nodes, weights):
        turn = np.exp(1j * np.pi * (1 - x) / 2)
        solved = np.linalg.solve((centre + radius * turn) * eye - matrix, block.astype(complex))
        total += w / 2 * (radius * turn * solved).real
    return total


def solve_interval(matrix: np.ndarray, low: float, high: float, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``number`` eigenvalues, falling, and unit eigenvectors (columns) of an interval."""
    size = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max())
    if number > 1 and high - low <= 4e-10 * scale:  # a cluster: its circle is as narrow as rounding
        low, high = low - 1e-9 * scale, high + 1e-9 * scale
    random = np.random.default_rng(0)
    width = min(size, 2 * number + 4)
    block, tries = random.standard_normal((size, width)), 0
    while True:
        basis, _ = np.linalg.qr(project(matrix, block, low, high)) if width < size else (np.eye(size), None)
        values, ritz = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ ritz
        residual = np.linalg.norm(matrix @ block - block * values, axis=0)
        inside = (values >= low) & (values <= high)
        done = int(inside.sum()) == number and residual[inside].max() <= max(RESIDUAL, 4 * size * np.finfo(float).eps) * scale
        if width == size or done:
            chosen = np.flatnonzero(inside) if done else np.argsort(np.abs(values - (low + high) / 2), kind="stable")[:number]
            order = chosen[np.argsort(-values[chosen], kind="stable")]
            return values[order], block[:, order]
        tries += 1
        if tries % 4 == 0:
            width = min(size, 2 * width)
            block = np.concatenate([block, random.standard_normal((size, width - block.shape[1]))], axis=1)
