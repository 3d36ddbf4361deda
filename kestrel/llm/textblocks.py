"""Vectorised word handling over Arrow string columns.

A record batch of texts is walked in blocks of a few megabytes. Inside a block
every step is one numpy pass over the UTF-8 bytes of all its documents: word
limits, 64-bit word hashes, hashes of word n-grams. No Python string is built
per word, and memory follows the block size (or the longest single text).

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, that is
``[^\\x20\\x09-\\x0D]+``; those bytes never occur inside a multi-byte code point.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
IDENTITY = np.arange(256, dtype=np.uint8)
ASCII_LOWER = IDENTITY.copy()
ASCII_LOWER[65:91] += 32

_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a uint64 over all its bits (a bijection)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random uint64 values."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=_U) + _U(seed) * _U(1 << 32)) * _U(0x9E3779B97F4A7C15))


class Roller:
    """Polynomial hash modulo 2**64 of any slice of a sequence, from prefix sums."""

    def __init__(self, seed: int):
        self.table = seeded(256, seed)
        self.base = seeded(1, seed + 7)[0] | _U(1)
        self.inverse = _U(pow(int(self.base), -1, 1 << 64))
        self._up = np.ones(1, dtype=_U)
        self._down = np.ones(1, dtype=_U)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            size = 1 << int(n - 1).bit_length()
            up, down = np.full(size, self.base), np.full(size, self.inverse)
            up[0] = down[0] = 1
            self._up, self._down = np.cumprod(up, dtype=_U), np.cumprod(down, dtype=_U)
        return self._up[:n], self._down[:n]

    def prefix(self, values: np.ndarray) -> np.ndarray:
        out = np.empty(len(values) + 1, dtype=_U)
        out[0] = 0
        np.cumsum(values * self._powers(len(values) + 1)[0][:-1], dtype=_U, out=out[1:])
        return out

    def slices(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for each pair of limits."""
        down = self._powers(len(prefix))[1]
        return mix64((prefix[end] - prefix[start]) * down[start] + (end - start).astype(_U))


WORD_HASH = Roller(11)
NGRAM_HASH = Roller(23)


@dataclass
class Block:
    """Some consecutive documents of a batch."""

    rows: slice             # rows of the batch
    data: np.ndarray        # their bytes, uint8
    doc_start: np.ndarray   # byte limits per document, relative to data
    doc_end: np.ndarray
    word_start: np.ndarray  # byte limits per word
    word_end: np.ndarray
    word_doc: np.ndarray    # document (0-based in the block) of each word
    first_word: np.ndarray  # per document, index of its first word; one more at the end

    @property
    def n_docs(self) -> int:
        return len(self.doc_start)

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first_word)

    def word_hashes(self, fold: np.ndarray = IDENTITY, roller: Roller = WORD_HASH) -> np.ndarray:
        """64-bit hash per word; ``fold`` maps bytes first (for example to lower case)."""
        prefix = roller.prefix(roller.table[fold[self.data]])
        return roller.slices(prefix, self.word_start, self.word_end)

    def ngrams(self, hashes: np.ndarray, n: int, roller: Roller = NGRAM_HASH) -> tuple[np.ndarray, np.ndarray]:
        """(hash, position of the first word) of every n-word window inside one document."""
        if len(hashes) < n:
            return np.empty(0, dtype=_U), np.empty(0, dtype=np.int64)
        at = np.flatnonzero(self.word_doc[: len(hashes) - n + 1] == self.word_doc[n - 1:])
        prefix = roller.prefix(hashes)
        return roller.slices(prefix, at, at + n), at


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null texts count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(column) == 0:
        return np.empty(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    offs = np.frombuffer(offsets, dtype=kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw, offs


def byte_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets from 0) of runs of whole documents of about ``block_bytes``."""
    raw, offs = text_buffers(column)
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + block_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield slice(lo, hi), raw[offs[lo]: offs[hi]], offs[lo: hi + 1] - offs[lo]
        lo = hi


def blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    for rows, data, offs in byte_blocks(column, block_bytes):
        yield cut_words(rows, data, offs)


def cut_words(rows: slice, data: np.ndarray, offs: np.ndarray) -> Block:
    n = len(data)
    inside = ~_SPACE[data]
    begins = np.zeros(n + 1, dtype=bool)
    begins[:n] = inside
    begins[1:n] &= ~inside[:-1]
    ends = np.zeros(n + 1, dtype=bool)
    ends[1:] = inside
    ends[1:n] &= ~inside[1:]
    # A document's first byte begins a word, and its last byte ends one.
    cut = offs[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    begins[cut] |= inside[cut]
    ends[cut] |= inside[cut - 1]
    word_start, word_end = np.flatnonzero(begins), np.flatnonzero(ends)
    first_word = np.searchsorted(word_start, offs, side="left")
    word_doc = np.repeat(np.arange(len(offs) - 1), np.diff(first_word))
    return Block(rows, data, offs[:-1], offs[1:], word_start, word_end, word_doc, first_word)


def segment_sums(values: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Sum of values[limits[i]:limits[i+1]] for each i."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[limits[1:]] - total[limits[:-1]]


def count_words(column: pa.Array) -> np.ndarray:
    """Words per text; null: 0."""
    out = [np.empty(0, dtype=np.int64)]
    for _, data, offs in byte_blocks(column):
        inside = ~_SPACE[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        cut = offs[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        begins[cut] |= inside[cut]
        out.append(segment_sums(begins, offs))
    return np.concatenate(out)
