"""Hilbert curve keys of points on an integer grid, vectorised."""

from __future__ import annotations

import numpy as np

_U = np.uint64


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of each point, as uint64.

    ``points`` is (n, d) with values below ``2**bits``, ``bits * d`` at most 64. The
    method is Skilling's transposition: undo the rotations of each level from the
    top, Gray-decode, then interleave the bits.
    """
    x = points.astype(_U).T.copy()
    d = len(x)
    if bits * d > 64:
        raise ValueError("a key has 64 bits")
    for level in range(bits - 1, 0, -1):
        q, low = _U(1 << level), _U((1 << level) - 1)
        for i in range(d):
            on = (x[i] & q) != 0
            # Where the bit is set the first axis is mirrored, elsewhere exchanged.
            swap = np.where(on, _U(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], dtype=_U)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[d - 1] & _U(1 << level)) != 0, _U((1 << level) - 1), _U(0))
    x ^= flip
    key = np.zeros(x.shape[1], dtype=_U)
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << _U(1)) | ((x[i] >> _U(level)) & _U(1))
    return key
