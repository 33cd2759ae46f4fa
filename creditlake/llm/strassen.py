"""Matrix products of whole numbers by Strassen's recursion.

Seven products of half size take the place of eight, with eighteen additions.
Additions and products are those of 64-bit integers, which wrap around: every
entry that fits in 64 bits comes out exact, whatever wrapped on the way. Object
arrays of Python integers take the same recursion and never wrap.
"""

from __future__ import annotations

import numpy as np

# Halves are taken as long as no side gets shorter than this.
LEAF = 8


def multiply(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b``; sides that do not halve evenly are padded with zeros."""
    rows, inner, columns = len(a), len(b), b.shape[1]
    depth = 0
    while min(rows, inner, columns) >> (depth + 1) >= leaf:
        depth += 1
    return _product(_padded(a, 1 << depth), _padded(b, 1 << depth), depth)[:rows, :columns]


def _padded(m: np.ndarray, unit: int) -> np.ndarray:
    rows, columns = (-(-side // unit) * unit for side in m.shape)
    if (rows, columns) == m.shape:
        return m
    wide = np.zeros((rows, columns), m.dtype)
    wide[: m.shape[0], : m.shape[1]] = m
    return wide


def _product(a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    if not depth:
        return a @ b
    i, j, k = len(a) // 2, len(b) // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    m1 = _product(a11 + a22, b11 + b22, depth - 1)
    m2 = _product(a21 + a22, b11, depth - 1)
    m3 = _product(a11, b12 - b22, depth - 1)
    m4 = _product(a22, b21 - b11, depth - 1)
    m5 = _product(a11 + a12, b22, depth - 1)
    m6 = _product(a21 - a11, b11 + b12, depth - 1)
    m7 = _product(a12 - a22, b21 + b22, depth - 1)
    made = np.empty((2 * i, 2 * k), m1.dtype)
    made[:i, :k] = m1 + m4 - m5 + m7
    made[:i, k:] = m3 + m5
    made[i:, :k] = m2 + m4
    made[i:, k:] = m1 - m2 + m3 + m6
    return made
