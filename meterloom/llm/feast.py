"""Largest eigenpairs of a symmetric matrix by contour integration (FEAST).

Inertia counts (the signs of a block-diagonal factorisation of the shifted matrix) tell how many
eigenvalues lie above a point; bisection on them finds an interval that holds the wanted ones and
whose lower end is a gap. The spectral projector of the interval is a contour integral of
the resolvent: Gauss-Legendre quadrature of complex shifted solves applied to a random block. A
Rayleigh-Ritz step on the projected block gives eigenpairs, which start the next round. It ends
when as many pairs with small residuals lie in the interval as the inertia counts say."""

from __future__ import annotations

import numpy as np

NODES = 12
ROUNDS = 40
#: Residuals and gaps, as a share of the matrix norm.
RESIDUAL = 1e-14
GAP = 1e-7
#: Bunch and Kaufman's bound on the growth of the factors.
PIVOT = (1 + 17**0.5) / 8


def n_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues above shift: the positive ones of matrix - shift, counted on a symmetric
    factorisation with pivots of one or two rows (complete pivoting)."""
    left = matrix - shift * np.eye(len(matrix))
    count = 0
    while len(left):
        size = np.abs(left)
        if not (most := size.max()):
            break
        at = int(np.argmax(np.diagonal(size)))
        if size[at, at] >= PIVOT * most:
            rows = [at]
            count += left[at, at] > 0
        else:
            rows = sorted(divmod(int(np.argmax(size)), len(left)))
            count += 1  # such a block has one eigenvalue of each sign
        rest = np.delete(np.arange(len(left)), rows)
        solved = np.linalg.solve(left[np.ix_(rows, rows)], left[np.ix_(rows, rest)])
        left = left[np.ix_(rest, rest)] - left[np.ix_(rest, rows)] @ solved
        left = (left + left.T) / 2
    return int(count)


def _bracket(matrix: np.ndarray, k: int, top: float) -> tuple[float, float]:
    """Two close points, the k-th largest eigenvalue between them."""
    low, high = -top, top
    while high - low > GAP * top / 4:
        middle = (low + high) / 2
        if n_above(matrix, middle) >= k:
            low = middle
        else:
            high = middle
    return low, high


def interval_of(matrix: np.ndarray, k: int, top: float) -> tuple[float, int]:
    """A point in a gap with at least k eigenvalues above it, and how many they are."""
    low, _ = _bracket(matrix, k, top)
    step = GAP * top
    while (many := n_above(matrix, low - step)) > k:  # ties: take them all
        k, low, step = many, low - step, 2 * step
    while low - 2 * step > -top and n_above(matrix, low - 2 * step) == k:
        step *= 2
    return low - step / 2, k


def _projected(matrix: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block under the projector of the eigenvalues between low and high."""
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(block)
    for node, weight in zip(*np.polynomial.legendre.leggauss(NODES)):
        turn = radius * np.exp(1j * np.pi / 2 * (1 - node))
        shifted = (centre + turn) * np.eye(len(matrix)) - matrix
        out += weight / 2 * (turn * np.linalg.solve(shifted, block)).real
    return out


def largest_pairs(matrix: np.ndarray, k: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns;
    of each vector the largest entry is positive. Equal eigenvalues get some basis."""
    d = len(matrix)
    k = min(k, d)
    top = float(np.linalg.norm(matrix))
    if not k or not top:
        return np.zeros(k), np.eye(d, k)
    low, many = interval_of(matrix, k, top)
    high = 1.1 * top
    width = min(d, 2 * many + 8)
    block = np.random.default_rng(seed).standard_normal((d, width))
    for turn in range(ROUNDS):
        if turn == ROUNDS // 2 and width < d:  # a poor start: all directions, so nothing is missed
            block = np.random.default_rng(seed + 1).standard_normal((d, d))
        basis, sizes, _ = np.linalg.svd(_projected(matrix, block, low, high), full_matrices=False)
        basis = basis[:, sizes > 1e-15 * sizes[0]]
        values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ turned
        residuals = np.linalg.norm(matrix @ block - block * values, axis=0)
        inside = (values > low) & (values < high)
        good = inside & (residuals <= RESIDUAL * top * d**0.5)
        if good.sum() == many == inside.sum():
            order = np.flatnonzero(good)[::-1][:k]
            vectors = block[:, order] / np.linalg.norm(block[:, order], axis=0)
            peak = vectors[np.abs(vectors).argmax(axis=0), np.arange(k)]
            return values[order], vectors * np.where(peak < 0, -1.0, 1.0)
    raise ArithmeticError(f"{good.sum()} of {many} eigenvalues above {low} found")
