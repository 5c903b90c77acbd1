"""Hilbert keys of points on an integer grid (vectorised)."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of each row of ``cells`` (n points x m axes, each coordinate
    in [0, 2**bits)); m * bits is at most 63. Neighbours on the curve are neighbours on the grid.

    Per level, from the top bit down: undo the reflection and rotation that the curve applies to
    that level's sub-cube, then read the Gray code of the axes off bit by bit.
    """
    x = [c.astype(np.int64).copy() for c in cells.T]
    m = len(x)
    if m * bits > 63:
        raise ValueError("more than 63 key bits")
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(m):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, m):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where(x[m - 1] & (1 << level), turn ^ ((1 << level) - 1), turn)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(m):
            key = (key << 1) | (((x[i] ^ turn) >> level) & 1)
    return key
