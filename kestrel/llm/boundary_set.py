"""A compressed set of cut positions with rank selection.

Positions are split by their high bits into chunks of 65,536; the low bits of a
chunk lie in the smallest of three containers: a sorted array, a bitmap, or runs of
consecutive positions. Cumulative cardinalities over the chunks find the container
of a rank, and the container selects inside itself.
"""

from __future__ import annotations

import numpy as np

CHUNK_BITS = 16
CHUNK = 1 << CHUNK_BITS
MOST_IN_ARRAY = 4096
BITMAP_BYTES = CHUNK // 8


class ArrayContainer:
    """Sorted 16-bit values."""

    def __init__(self, low: np.ndarray):
        self.values = low.astype(np.uint16)

    def select(self, rank: int) -> int:
        return int(self.values[rank])


class BitmapContainer:
    """One bit per value, with the number of set bits before each word of 64."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(CHUNK, dtype=bool)
        bits[low] = True
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def select(self, rank: int) -> int:
        word = int(np.searchsorted(self.before, rank, side="right")) - 1
        bits = int(self.words[word])
        for _ in range(rank - int(self.before[word])):
            bits &= bits - 1  # drop the lowest set bit
        return (word << 6) + (bits & -bits).bit_length() - 1


class RunContainer:
    """First value of each run, with the number of values before it."""

    def __init__(self, low: np.ndarray, run_at: np.ndarray):
        self.starts = low[run_at].astype(np.uint16)
        self.before = run_at

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.before, rank, side="right")) - 1
        return int(self.starts[run]) + rank - int(self.before[run])


def container_of(low: np.ndarray):
    """The smallest container for the sorted low bits of one chunk."""
    run_at = np.flatnonzero(np.diff(low, prepend=low[0] - 2) != 1)
    array_bytes = 2 * len(low) if len(low) <= MOST_IN_ARRAY else BITMAP_BYTES + 1
    if 4 * len(run_at) < min(array_bytes, BITMAP_BYTES):
        return RunContainer(low, run_at)
    return ArrayContainer(low) if array_bytes <= BITMAP_BYTES else BitmapContainer(low)


class BoundarySet:
    """The set of the given positions (sorted, distinct, not negative)."""

    def __init__(self, positions: np.ndarray):
        chunk = positions >> CHUNK_BITS
        first = np.flatnonzero(np.diff(chunk, prepend=-1)) if len(chunk) else np.empty(0, dtype=np.int64)
        self.keys = chunk[first]
        self.before = np.append(first, len(positions))
        low = positions & (CHUNK - 1)
        self.containers = [container_of(low[a:b]) for a, b in zip(self.before[:-1], self.before[1:])]

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, rank: int) -> int:
        """The position with ``rank`` smaller ones in the set."""
        if not 0 <= rank < len(self):
            raise IndexError(f"rank {rank} of {len(self)} positions")
        at = int(np.searchsorted(self.before, rank, side="right")) - 1
        return (int(self.keys[at]) << CHUNK_BITS) + self.containers[at].select(rank - int(self.before[at]))
