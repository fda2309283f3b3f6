"""Places of vectors along a Hilbert curve through their main directions."""

from __future__ import annotations

import numpy as np

# Directions the curve runs through, and the bits of each: a key has 64 bits.
AXES = 8
BITS = 8


def curve_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place along the curve of each row of cell numbers, as unsigned 64-bit.

    The known way of undoing the curve's reflections and exchanges bit by bit
    from the top, then reading the Gray code, here for all rows at once.
    """
    x = [cells[:, axis].astype(np.uint64) for axis in range(cells.shape[1])]
    one = np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        q, below = one << np.uint64(bit), (one << np.uint64(bit)) - one
        for axis in range(len(x)):
            inverted = (x[axis] & q) != 0
            swap = np.where(inverted, np.uint64(0), (x[0] ^ x[axis]) & below)
            x[0] = np.where(inverted, x[0] ^ below, x[0] ^ swap)
            x[axis] = x[axis] ^ swap
    for axis in range(1, len(x)):
        x[axis] = x[axis] ^ x[axis - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        q = one << np.uint64(bit)
        flip ^= np.where(x[-1] & q, q - one, np.uint64(0))
    key = np.zeros_like(flip)
    for bit in range(bits - 1, -1, -1):
        for value in x:
            key = (key << one) | (((value ^ flip) >> np.uint64(bit)) & one)
    return key


class Curve:
    """Turns vectors into cell numbers by the main directions of a sample."""

    def __init__(self, sample: np.ndarray):
        sample = sample.astype(np.float64)
        self.middle = sample.mean(axis=0)
        _, _, directions = np.linalg.svd(sample - self.middle, full_matrices=False)
        self.directions = directions[:AXES].T
        shown = (sample - self.middle) @ self.directions
        self.low = shown.min(axis=0)
        self.span = np.maximum(shown.max(axis=0) - self.low, 1e-9)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """Signed 64-bit keys in the order of the curve; outside of the sample's range, its edge."""
        shown = (vectors.astype(np.float64) - self.middle) @ self.directions
        cells = np.clip((shown - self.low) / self.span, 0, 1) * ((1 << BITS) - 1)
        return (curve_keys(cells.astype(np.int64)) ^ np.uint64(1 << 63)).view(np.int64)
