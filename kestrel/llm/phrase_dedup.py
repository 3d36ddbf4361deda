"""Substring deduplication with repeated-phrase automata (operator 1).

A window is ``window`` consecutive words. A window of a document goes when its
words also start somewhere in a document with a smaller id.

1. *Candidates.* Each window names one of its ``anchor``-word phrases, the one of
   smallest hash (winnowing). Equal windows name equal anchors, and a document
   has about one anchor in twenty words. Anchors that occur in two documents or
   more (minimum and maximum id differ) recur.
2. *Segments.* The windows of a document that name one occurrence of a recurring
   anchor form a segment, at most ``2 * window - anchor`` words. Equal segments
   are kept once, with their smallest and largest document.
3. *Confirmed passages.* Windows of the distinct segments are counted by hash; a
   window recurs if its smallest and largest document differ. Its home is a
   segment of its smallest document, and runs of windows at home in one segment
   are a passage.
4. *Automata.* Passages are dealt to shards by anchor. In each passage tiles of
   half a window are placed so that each window holds a whole tile, preferring
   tiles that few passages hold. Each shard compiles one
   Aho-Corasick automaton of its tiles, over strings of one code point per word,
   and streams the distinct segments of its anchors through it. Each hit is
   extended to both sides word by word and counts from ``window`` equal words.
   Shards hold about ``PASSAGES_PER_SHARD`` passages: an anchor with more is split
   by the hash of the window, which equal windows share (``_sharded``). A shard with
   many segments is split into several streams that compile the same automaton.
5. The matches return to the documents through the segment ids; words covered by
   a match of a smaller document are removed.

Null and empty texts have no words. Rows with a null id neither remove nor lose
anything. Repeated rows (same id and text) lose the same words. Shorter texts
than a window are returned whole. Extra columns are ignored, an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import written
from kestrel.llm.textblocks import NGRAM_HASH, Block, Roller, blocks

WINDOW, ANCHOR = 50, 10
PASSAGES_PER_SHARD = 2_000
SEGMENTS_PER_STREAM = 4_000
_U = np.uint64
_SECOND_HASH = Roller(53)
_CODE = Roller(61)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest value of every run of ``width`` values."""
    at, low, size = np.arange(len(values)), values, 1
    while size * 2 <= width:
        left, right = low[:-size], low[size:]
        take = left <= right
        at, low = np.where(take, at[: len(left)], at[size: size + len(left)]), np.where(take, left, right)
        size *= 2
    rest = width - size
    if rest:
        left, right = low[:-rest], low[rest:]
        at = np.where(left <= right, at[: len(left)], at[rest: rest + len(left)])
    return at


def _anchored(b: Block, window: int, anchor: int):
    """(window starts, position of each window's anchor, hashes of all phrases)."""
    hashes = b.word_hashes()
    n = len(hashes)
    if n < window:
        none = np.empty(0, dtype=np.int64)
        return none, none, np.empty(0, dtype=_U)
    at = np.arange(n - anchor + 1)
    phrases = NGRAM_HASH.slices(NGRAM_HASH.prefix(hashes), at, at + anchor)
    starts = np.flatnonzero(b.word_doc[: n - window + 1] == b.word_doc[window - 1:])
    return starts, _smallest(phrases, window - anchor + 1)[starts], phrases


def _first_of_runs(values: np.ndarray) -> np.ndarray:
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    return np.flatnonzero(new)


def _anchor_batches(window: int, anchor: int):
    """Rows (doc_id, text_key, text) to the distinct anchors of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch.column(2)):
                starts, at, phrases = _anchored(b, window, anchor)
                if not len(starts):
                    continue
                at = at[_first_of_runs(at)]
                doc = b.word_doc[at]
                order = np.lexsort((phrases[at], doc))
                doc, value = doc[order], phrases[at][order]
                keep = np.ones(len(doc), dtype=bool)
                keep[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
                rows = pa.array(doc[keep] + b.rows.start)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(value[keep].view(np.int64))],
                    names=["doc_id", "text_key", "anchor"])
    return run


def _joined_words(b: Block) -> tuple[bytes, np.ndarray]:
    """The block's words, each followed by one space, and where each word starts."""
    sizes = b.word_end - b.word_start
    start = np.concatenate([[0], np.cumsum(sizes + 1)])
    out = np.full(int(start[-1]), 0x20, dtype=np.uint8)
    marks = np.zeros(len(b.data) + 1, dtype=np.int64)
    marks[b.word_start] += 1
    np.subtract.at(marks, b.word_end, 1)
    keep = np.cumsum(marks[:-1]).astype(bool)
    inside = np.ones(len(out), dtype=bool)
    inside[start[1:] - 1] = False
    out[inside] = b.data[keep]
    return out.tobytes(), start


def _segment_batches(window: int, anchor: int):
    """Rows (doc_id, text_key, anchors, text) to segments around recurring anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(2)
            wanted_at = wanted.offsets.to_numpy()
            wanted_values = wanted.values.to_numpy().view(_U)
            for b in blocks(batch.column(3)):
                starts, at, phrases = _anchored(b, window, anchor)
                if not len(starts):
                    continue
                first = _first_of_runs(at)
                last = np.append(first[1:], len(at)) - 1
                lo, hi, at = starts[first], starts[last] + window, at[first]
                doc = b.word_doc[lo] + b.rows.start
                keep = np.zeros(len(at), dtype=bool)
                limits = np.searchsorted(doc, np.arange(b.rows.start, b.rows.stop + 1))
                for d in range(b.rows.start, b.rows.stop):
                    i, j = limits[d - b.rows.start], limits[d - b.rows.start + 1]
                    if i < j:
                        keep[i:j] = np.isin(phrases[at[i:j]], wanted_values[wanted_at[d]: wanted_at[d + 1]])
                if not keep.any():
                    continue
                lo, hi, at, doc = lo[keep], hi[keep], at[keep], doc[keep]
                text, place = _joined_words(b)
                hashes = b.word_hashes()
                sid_hi = _SECOND_HASH.slices(_SECOND_HASH.prefix(hashes), lo, hi)
                sid_lo = NGRAM_HASH.slices(NGRAM_HASH.prefix(hashes), lo, hi)
                words = [text[i:j] for i, j in zip(place[lo].tolist(), (place[hi] - 1).tolist())]
                rows = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(phrases[at].view(np.int64)),
                     pa.array((lo - b.first_word[doc - b.rows.start]).astype(np.int32)),
                     pa.array(sid_hi.view(np.int64)), pa.array(sid_lo.view(np.int64)), pa.array(words, pa.binary()).cast(pa.string())],
                    names=["doc_id", "text_key", "anchor", "start", "sid_hi", "sid_lo", "words"])
    return run


# The low bits of a window's home hold its offset in the home segment.
_OFFSET_BITS = 6


def _window_batches(window: int):
    """Rows (sid_lo, first, last, words) to the hashes of all windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid = batch.column(0).to_numpy(zero_copy_only=False)
            first = batch.column(1).to_numpy(zero_copy_only=False)
            last = batch.column(2).to_numpy(zero_copy_only=False)
            for b in blocks(batch.column(3)):
                grams, at = b.ngrams(b.word_hashes(), window)
                row = b.word_doc[at]
                offset = at - b.first_word[row]
                row = row + b.rows.start
                home = ((sid[row] >> _OFFSET_BITS) << _OFFSET_BITS) | offset
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams.view(np.int64)), pa.array(first[row]), pa.array(last[row]), pa.array(home)],
                    names=["w", "first", "last", "home"])
    return run


class PhraseAutomaton:
    """An Aho-Corasick automaton of the tiles of some passages.

    A word is one code point (a hash); hits are verified on the words themselves.
    """

    def __init__(self, window: int):
        self.window, self.tile = window, window // 2
        self.passages: list[tuple[list[bytes], str, int]] = []
        self.tiles: dict[str, list[tuple[int, int]]] = {}
        self.automaton = None

    def add(self, words: list[bytes], codes: str, first: int) -> None:
        self.passages.append((words, codes, first))

    def _place_tiles(self) -> None:
        """Choose tiles so that each window of each passage holds one, and the tiles
        are those that the fewest passages hold: what many passages share (a common
        passage amid different texts) then leads to few of them."""
        held = Counter()
        for _, codes, _ in self.passages:
            held.update({codes[i: i + self.tile] for i in range(len(codes) - self.tile + 1)})
        slack = self.window - self.tile
        for number, (_, codes, _) in enumerate(self.passages):
            chosen = -1
            for s in range(len(codes) - self.window + 1):
                if chosen < s:
                    # The rarest tile of the window; of equals the last, which serves most windows.
                    chosen = min(range(s + slack, s - 1, -1), key=lambda i: held[codes[i: i + self.tile]])
                    self.tiles.setdefault(codes[chosen: chosen + self.tile], []).append((number, chosen))

    def compile(self) -> None:
        self._place_tiles()
        if self.tiles:
            self.automaton = ahocorasick.Automaton()
            for codes, places in self.tiles.items():
                self.automaton.add_word(codes, places)
            self.automaton.make_automaton()

    def matches(self, words: list[bytes], codes: str) -> Iterator[tuple[int, int, int]]:
        """(start, end, first document) of stretches of at least a window that equal
        part of a passage."""
        if self.automaton is None:
            return
        done: dict[tuple[int, int], int] = {}  # per passage and shift, the end of its last stretch
        for end, places in self.automaton.iter(codes):
            at = end - self.tile + 1
            for number, off in places:
                shift = at - off
                if end < done.get((number, shift), 0):
                    continue
                passage, _, first = self.passages[number]
                lo, hi = at, end + 1
                if words[lo:hi] != passage[off: off + self.tile]:
                    continue
                while lo > 0 and lo - shift > 0 and words[lo - 1] == passage[lo - 1 - shift]:
                    lo -= 1
                most = min(len(words), len(passage) + shift)
                while hi < most and words[hi] == passage[hi - shift]:
                    hi += 1
                done[number, shift] = hi  # later tiles inside it would find it again
                if hi - lo >= self.window:
                    yield lo, hi, first


_SURROGATES = 0xD800


def _codes(b: Block) -> str:
    """One code point per word, outside the surrogates and never 0."""
    value = (b.word_hashes(roller=_CODE) >> _U(44)).astype(np.uint32)  # 20 bits
    value = np.where(value < _SURROGATES - 1, value + 1, value + 0x801)
    return value.astype("<u4").tobytes().decode("utf-32-le")


def _locate_batches(window: int):
    """Rows sorted by (stream, kind): a stream's passages (kind 0: first, mask, words)
    come before its segments (kind 1), whose matches are returned."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, automaton, compiled = None, None, False
        for batch in batches:
            streams, kinds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            sid_hi, sid_lo = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            firsts, masks = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            out = []
            for b in blocks(batch.column(6)):
                codes = _codes(b)
                data = b.data.tobytes()
                for d in range(b.n_docs):
                    i = b.rows.start + d
                    lo, hi = b.first_word[d], b.first_word[d + 1]
                    words = data[b.doc_start[d]: b.doc_end[d]].split(b" ")
                    if streams[i] != stream:
                        stream, automaton, compiled = streams[i], PhraseAutomaton(window), False
                    if kinds[i] == 0:
                        for s, e in _runs(masks[i], window):
                            automaton.add(words[s:e], codes[lo + s: lo + e], firsts[i])
                        continue
                    if not compiled:
                        automaton.compile()
                        compiled = True
                    out += [(sid_hi[i], sid_lo[i], s, e, first) for s, e, first in automaton.matches(words, codes[lo:hi])]
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["sid_hi", "sid_lo", "s", "e", "first"])
    return run


def _runs(mask: int, window: int) -> list[tuple[int, int]]:
    """Word limits of the runs of windows whose offsets are set in ``mask``."""
    out, start = [], None
    for i in range(mask.bit_length() + 1):
        if mask >> i & 1:
            start = i if start is None else start
        elif start is not None:
            out.append((start, i - 1 + window))
            start = None
    return out


def _remove_batches(keep_text: bool):
    """Rows (doc_id, text, spans) to the digest of what is left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(2).to_pylist()
            n_removed, digests, kept_texts = [], [], []
            n_words = []
            for b in blocks(batch.column(1)):
                text, place = _joined_words(b)
                for d in range(b.n_docs):
                    lo, hi = int(b.first_word[d]), int(b.first_word[d + 1])
                    gone, parts, at = 0, [], lo
                    for s, e in _merged(spans[b.rows.start + d]):
                        parts.append(text[place[at]: place[lo + s]])
                        gone, at = gone + e - s, lo + e
                    parts.append(text[place[at]: place[hi]])
                    kept = b"".join(parts)[:-1]
                    n_words.append(hi - lo)
                    n_removed.append(gone)
                    digests.append(hashlib.sha256(kept).hexdigest())
                    if keep_text:
                        kept_texts.append(kept.decode())
            cols = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if keep_text:
                cols, names = [*cols, pa.array(kept_texts, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def _merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _split_batches(window: int):
    """Rows (shards, anchor, sid_hi, sid_lo, first, mask, words) once for each shard that
    one of the segment's windows hashes to, with the part of the mask that lies there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards = batch.column("shards").to_numpy(zero_copy_only=False)
            masks = batch.column("mask").fill_null(0).to_numpy(zero_copy_only=False)
            for b in blocks(batch.column("words")):
                grams, at = b.ngrams(b.word_hashes(), window)
                row = b.word_doc[at]
                offset = at - b.first_word[row]
                row = row + b.rows.start
                sub = (grams % shards[row].astype(_U)).astype(np.int64)
                place, inverse = np.unique((row << 32) | sub, return_inverse=True)
                mask = np.zeros(len(place), dtype=np.int64)
                np.bitwise_or.at(mask, inverse, masks[row] & (np.int64(1) << offset))
                rows = pa.array(place >> 32)
                names = [f"{a}.{k}" for a, k in zip(batch.column("anchor").take(rows).to_pylist(), (place & 0xFFFFFFFF).tolist())]
                kept = [batch.column(c).take(rows) for c in ("sid_hi", "sid_lo", "first")]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *kept, pa.array(mask, mask=mask == 0), batch.column("words").take(rows)],
                                                 names=["shard", "sid_hi", "sid_lo", "first", "mask", "words"])
    return run


def _sharded(marked: DataFrame, window: int, anchor: int) -> DataFrame:
    """The segments with their shards. Anchors are dealt by hash; those with more
    passages than a shard should hold (a phrase that many documents hold amid different
    texts) are split by the hash of the whole window, which equal windows share: a
    passage goes to the shards of its own windows, a segment to those of all of its, at
    most one per window."""
    columns = ["sid_hi", "sid_lo", "first", "mask", "words"]
    passages = marked.where("mask is not null")
    shards = max(1, math.ceil(passages.count() / PASSAGES_PER_SHARD))
    windows = F.lit((window - anchor + 1) / PASSAGES_PER_SHARD)
    hot = written(passages.groupBy("anchor").agg(F.count("*").alias("p")).where(F.col("p") > PASSAGES_PER_SHARD)
                  .select("anchor", F.ceil(F.col("p") * windows).cast("bigint").alias("shards")), "hot-anchors")
    plain = lambda rows: rows.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("string").alias("shard"), *columns)
    if hot.isEmpty():
        return plain(marked)
    split = marked.join(hot, "anchor").select("shards", "anchor", *columns).mapInArrow(
        _split_batches(window), "shard string, sid_hi bigint, sid_lo bigint, first bigint, mask bigint, words string")
    return plain(marked.join(hot, "anchor", "left_anti")).union(written(split, "split-segments"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, text_key, spans) for rows (doc_id, text_key, text): the stretches of
    words, as word positions, that a document with a smaller id holds too."""
    if not 0 < window - anchor < 63 or anchor < 1:
        raise ValueError("window must be longer than anchor, by less than 63 words")
    docs = docs.where("doc_id is not null")
    anchors = written(docs.mapInArrow(_anchor_batches(window, anchor), "doc_id bigint, text_key bigint, anchor bigint"), "anchors")
    recurring = anchors.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("anchor")
    wanted = anchors.join(recurring, "anchor").groupBy("doc_id", "text_key").agg(F.collect_set("anchor").alias("anchors"))
    segments = written(docs.join(wanted, ["doc_id", "text_key"]).select("doc_id", "text_key", "anchors", "text").mapInArrow(
        _segment_batches(window, anchor),
        "doc_id bigint, text_key bigint, anchor bigint, start int, sid_hi bigint, sid_lo bigint, words string"), "segments")
    distinct = written(segments.groupBy("sid_hi", "sid_lo").agg(
        F.first("anchor").alias("anchor"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.first("words").alias("words")), "distinct-segments")
    low = F.shiftleft(F.shiftright("sid_lo", _OFFSET_BITS), _OFFSET_BITS)
    windows = (distinct.select("sid_lo", "first", "last", "words")
               .mapInArrow(_window_batches(window), "w bigint, first bigint, last bigint, home bigint")
               .groupBy("w").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.min_by("home", "first").alias("home"))
               .where("first < last"))
    homes = windows.groupBy(F.shiftleft(F.shiftright("home", _OFFSET_BITS), _OFFSET_BITS).alias("low"), "first").agg(
        F.bit_or(F.expr("shiftleft(1L, cast(home & 63 as int))")).alias("mask"))
    marked = written(distinct.withColumn("low", low).join(homes, ["low", "first"], "left").drop("low", "last"), "marked-segments")
    sharded = _sharded(marked, window, anchor)
    sizes = sharded.groupBy("shard").agg(F.ceil(F.count("*") / SEGMENTS_PER_STREAM).alias("streams"))
    dealt = sharded.join(sizes, "shard")
    columns = ["sid_hi", "sid_lo", "first", "mask", "words"]
    passages = dealt.where("mask is not null").select("shard", F.explode(F.sequence(F.lit(0), F.col("streams") - 1)).alias("salt"), F.lit(0).alias("kind"), *columns)
    scanned = dealt.select("shard", F.pmod(F.xxhash64("sid_hi", "sid_lo"), F.col("streams")).alias("salt"), F.lit(1).alias("kind"), *columns)
    stream = F.concat_ws(":", "shard", "salt").alias("stream")
    streams = passages.union(scanned).select(stream, "kind", *columns)
    hits = written(streams.repartition("stream").sortWithinPartitions("stream", "kind").mapInArrow(
        _locate_batches(window), "sid_hi bigint, sid_lo bigint, s bigint, e bigint, first bigint"), "matches")
    return (segments.select("doc_id", "text_key", "start", "sid_hi", "sid_lo").join(hits, ["sid_hi", "sid_lo"]).where("first < doc_id")
            .select("doc_id", "text_key", F.struct((F.col("start") + F.col("s")).alias("s"), (F.col("start") + F.col("e")).alias("e")).alias("span"))
            .groupBy("doc_id", "text_key").agg(F.collect_set("span").alias("spans")))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   anchor: int = ANCHOR, keep_text: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 and, if
    ``keep_text``, the kept words joined by one space."""
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    spans = repeated_spans(docs, window, anchor)
    out = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * keep_text
    return docs.join(spans, ["doc_id", "text_key"], "left").select("doc_id", "text", "spans").mapInArrow(_remove_batches(keep_text), out)
