"""Best-fit packing of documents into token sequences (operator 10).

1. *Tokens.* Texts are cut before single blanks between two words, where the
   byte-level tokenizer always starts a new piece of its own, so a document's
   ids are those of its chunks one after the other. Each task encodes a distinct
   chunk once and looks the others up by hash; the rest is numpy.
2. *Pieces.* A document longer than a sequence is cut into full sequences after a
   first piece that takes the remainder. Full pieces are sequences of their own.
3. *Vector best-fit.* The other pieces are dealt by hash to groups of bounded
   size. In a group, pieces go from the longest to the shortest. A bin has three
   residual capacities, as shares of the whole: tokens, documents and attention
   cost (the sum of squared lengths). Of the bins in which a piece fits under
   every one, ``dot`` takes the largest weighted dot product of the piece's
   demand and the residual, ``norm`` the smallest weighted norm of what would be
   left. Bins alike in all three capacities are one entry, so a choice looks at
   the distinct residuals and not at all bins.

Null and empty texts are one token long, the closing id. Repeated rows are packed
as separate documents under their common id. Extra columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import math
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import lean, written
from kestrel.llm.textblocks import Roller, byte_blocks

SEQUENCE, END_ID = 2048, 0
GROUP_PIECES = 20_000
_CACHE_CHUNKS = 1_000_000
_BLOCK = 1 << 18        # bytes encoded at once; the tables of the chunk hash grow with it
# Fixed value: the pattern by which the vocabulary's byte-level tokenizer cuts texts.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CHUNK_HASH = Roller(71)
_U = np.uint64

_PLAIN = np.zeros(256, dtype=bool)  # ASCII bytes that are neither space nor control
_PLAIN[0x21:0x7F] = True
_WIDE = np.zeros(256, dtype=bool)
_WIDE[0x80:] = True
# First bytes of the code points that may be white space beyond ASCII.
_SPACE_LEAD = np.zeros(256, dtype=bool)
_SPACE_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _chunk_starts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Byte positions where chunks start: document starts, and single blanks or line
    feeds between two characters that are not white space."""
    n = len(data)
    start = np.zeros(n + 1, dtype=bool)
    if n > 2:
        before, here, after = data[:-2], data[1:-1], data[2:]
        solid_after = _PLAIN[after] | (_WIDE[after] & ~_SPACE_LEAD[after])
        # A wide character before is solid unless it may be one of the wide spaces.
        wide = _WIDE[before]
        lead2 = np.zeros(n - 2, dtype=bool)
        lead2[1:] = _SPACE_LEAD[data[:-3]] & (data[:-3] == 0xC2)
        lead3 = np.zeros(n - 2, dtype=bool)
        lead3[2:] = _SPACE_LEAD[data[:-4]] & (data[:-4] != 0xC2)
        solid_before = _PLAIN[before] | (wide & ~lead2 & ~lead3)
        start[1:-2] = ((here == 0x20) | (here == 0x0A)) & solid_before & solid_after
    start[offs[:-1]] = True
    return np.flatnonzero(start[:n])


# Chunks of these characters go to the quicker of two encoders of one vocabulary.
_LATIN_END = "\u0250"
_SPECIAL_MARK = "<|"


@functools.cache
def _rank_encoder(path: str):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


class ChunkEncoder:
    """Token ids of texts, each distinct chunk encoded once per cache filling.

    ``path`` is a tokenizer file. ``ranks``, optional, is the same vocabulary as
    byte ranks: a quicker library then encodes the chunks of Latin letters, digits
    and signs, on which both agree, and the tokenizer file the rest.
    """

    def __init__(self, path: str, ranks: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.quick = _rank_encoder(ranks) if ranks else None
        self._clear()

    def _clear(self):
        self.keys = np.empty(0, dtype=_U)    # sorted chunk hashes
        self.begin = np.empty(0, dtype=np.int64)
        self.count = np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.uint32)

    def _ids(self, chunks: list[str]) -> list[list[int]]:
        if self.quick is None:
            return [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        encode = self.quick.encode_ordinary
        plain = [max(c, default="") < _LATIN_END and _SPECIAL_MARK not in c for c in chunks]
        got = [encode(c) if p else None for c, p in zip(chunks, plain)]
        other = [i for i, p in enumerate(plain) if not p]
        for i, e in zip(other, self.tokenizer.encode_batch_fast([chunks[i] for i in other], add_special_tokens=False)):
            got[i] = e.ids
        return got

    def _learn(self, keys: np.ndarray, chunks: list[str]) -> None:
        """Add chunks not seen before; keys are sorted."""
        got = self._ids(chunks)
        count = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        ids = np.fromiter(chain.from_iterable(got), dtype=np.uint32, count=int(count.sum()))
        begin = len(self.ids) + np.concatenate([[0], np.cumsum(count)])[:-1]
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.begin, self.count = np.insert(self.begin, at, begin), np.insert(self.count, at, count)
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, limits): the ids of each document of a block."""
        start = _chunk_starts(data, offs)
        end = np.append(start[1:], len(data))
        prefix = _CHUNK_HASH.prefix(_CHUNK_HASH.table[data])
        keys = _CHUNK_HASH.slices(prefix, start, end)
        distinct, first = np.unique(keys, return_index=True)
        if len(self.keys) > _CACHE_CHUNKS:
            self._clear()
        at = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
        new = np.ones(len(distinct), dtype=bool) if not len(self.keys) else self.keys[at] != distinct
        if new.any():
            raw = data.tobytes()
            where = first[new]
            self._learn(distinct[new], [raw[s:e].decode() for s, e in zip(start[where].tolist(), end[where].tolist())])
        at = np.searchsorted(self.keys, keys)
        count = self.count[at]
        upto = np.concatenate([[0], np.cumsum(count)])
        ids = self.ids[np.repeat(self.begin[at] - upto[:-1], count) + np.arange(upto[-1])]
        return ids, upto[np.searchsorted(start, offs)]


def _piece_batches(path: str, ranks: str | None, sequence: int, end_id: int):
    """Rows (doc_id, text) to pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(path, ranks)
        closing = np.array([end_id], dtype="<u4")
        for batch in batches:
            rows, pieces, starts, lengths, crcs = [], [], [], [], []
            for block, data, offs in byte_blocks(batch.column(1), _BLOCK):
                ids, limits = encoder.encode(data, offs)
                for d in range(len(offs) - 1):
                    own = np.concatenate([ids[limits[d]: limits[d + 1]], closing]).astype("<u4", copy=False)
                    first = len(own) % sequence or sequence
                    cuts = [0, *range(first, len(own) + 1, sequence)]
                    for p, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
                        rows.append(block.start + d)
                        pieces.append(p)
                        starts.append(lo)
                        lengths.append(hi - lo)
                        crcs.append(zlib.crc32(own[lo:hi].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


@dataclass
class Capacity:
    """What a sequence holds. ``cost`` bounds the sum of squared piece lengths, by
    default that of one full piece, which no sequence can exceed."""

    tokens: int = SEQUENCE
    documents: int = SEQUENCE
    cost: int = SEQUENCE * SEQUENCE
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    choice: str = "norm"


def vector_best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; lengths must not exceed the capacities."""
    whole = np.array([capacity.tokens, capacity.documents, capacity.cost], dtype=np.float64)
    weights = np.array(capacity.weights) / whole  # residuals count as shares of the whole
    order = np.argsort(-lengths, kind="stable")
    bin_of, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    # Distinct residuals: a row of ``left`` each, with the open bins that have it.
    left = np.empty((1024, 3))
    held: list[list[int]] = []
    place: dict[tuple, int] = {}
    free: list[int] = []
    n_bins = 0

    def put(residual: tuple, number: int):
        nonlocal left
        if residual[0] <= 0 or residual[1] <= 0 or residual[2] <= 0:
            return
        row = place.get(residual)
        if row is None:
            if free:
                row = free.pop()
            else:
                row = len(held)
                held.append([])
                if row == len(left):
                    left = np.concatenate([left, np.empty_like(left)])
            place[residual] = row
            left[row] = residual
        held[row].append(number)

    for i in order.tolist():
        size = int(lengths[i])
        need = np.array([size, 1, size * size], dtype=np.float64)
        table = left[: len(held)]
        fits = (table >= need).all(axis=1)
        at = -1
        if fits.any():
            if capacity.choice == "dot":
                score = (table * weights) @ (need * weights)
                at = int(np.argmax(np.where(fits, score, -np.inf)))
            else:
                score = (((table - need) * weights) ** 2).sum(axis=1)
                at = int(np.argmin(np.where(fits, score, np.inf)))
        if at < 0:
            number, residual = n_bins, (capacity.tokens, capacity.documents, capacity.cost)
            n_bins += 1
        else:
            residual = tuple(int(x) for x in left[at])
            number = held[at].pop()
            if not held[at]:
                del place[residual]
                left[at] = -1
                free.append(at)
        bin_of[i], offset[i] = number, capacity.tokens - residual[0]
        put((residual[0] - size, residual[1] - 1, residual[2] - size * size), number)
    return bin_of, offset


def _pack_groups(capacity: Capacity):
    """Rows sorted by group; each group is packed as its last row arrives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        group = None

        def flush():
            rows = pa.Table.from_batches(held).combine_chunks()
            bins, offsets = vector_best_fit(rows.column("length").to_numpy(), capacity)
            out = rows.drop_columns(["g"]).append_column("sequence_id", pa.array((np.int64(group) << 32) + bins)).append_column("offset", pa.array(offsets))
            held.clear()
            return out.to_batches()

        for batch in batches:
            groups = batch.column(0).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(groups[1:] != groups[:-1]) + 1, [len(groups)]]) if len(groups) else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if held and groups[lo] != group:
                    yield from flush()
                group = groups[lo]
                held.append(batch.slice(int(lo), int(hi - lo)))
        if held:
            yield from flush()
    return run


def pieces_of(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE,
              end_id: int = END_ID, ranks: str | None = None) -> DataFrame:
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lean(_piece_batches(tokenizer, ranks, sequence, end_id)),
                           f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: Capacity | None = None,
         end_id: int = END_ID, group_pieces: int = GROUP_PIECES, ranks: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    capacity = capacity or Capacity()
    if capacity.documents < 1 or capacity.cost < capacity.tokens ** 2:
        raise ValueError("a sequence must be able to hold one full piece")
    pieces = written(pieces_of(df, tokenizer, id_col, text_col, capacity.tokens, end_id, ranks), "pieces")
    full = pieces.where(F.col("length") == capacity.tokens)
    rest = pieces.where(F.col("length") < capacity.tokens)
    groups = max(1, math.ceil(rest.count() / group_pieces))
    # The number of the row in the written table spreads rows that repeat a document.
    dealt = rest.withColumn("g", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int")).select("g", *pieces.columns)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id bigint, offset bigint"
    packed = (dealt.repartitionById(groups, F.col("g")).sortWithinPartitions("g", F.desc("length"), "doc_id", "piece", "start", "ids_crc32")
              .mapInArrow(lean(_pack_groups(capacity)), schema))
    # Full pieces: numbers above all groups'.
    alone = full.withColumn("sequence_id", F.monotonically_increasing_id() + (1 << 62)).withColumn("offset", F.lit(0).cast("bigint"))
    return packed.unionByName(alone)
