"""Near-duplicate documents by SuperMinHash (operator 3).

1. A document's set are the distinct shingles of ``shingle_words`` words (A-Z
   lower-cased). One numpy pass per text makes the 64-bit shingle hashes and a
   SuperMinHash signature: each element walks through the slots in an order of
   its own, a random permutation, and offers step number plus a fraction to the
   slot of each step. A document stops as soon as no later step can lower any of
   its slots, which for most is after a few steps.
2. Documents with equal sets are one node, named by the smallest doc_id; copies
   are never paired with each other.
3. Signatures are cut in bands. Nodes that share a band meet in a bucket.
   Pairs at the similarity limit share a band with a chance of 1 - 1.2e-7
   (40 bands of 5).
4. In each bucket all nodes are compared with the smallest one. Two bits of each
   slot, packed into a few words, tell first whether a pair can be similar at all,
   then the distinct 16-bit prints of the two sets, which no similar pair fails;
   the others are checked on full sets, and the links found are grouped
   (``components``). What is left are buckets
   whose nodes lie in several groups: there, node by node ("pivots"), the nodes
   outside the bucket's largest group are compared with the nodes of the other
   groups, until every pair of different groups was compared. Nodes already in
   one group need no further link, so a large group of copies costs one
   comparison per node and not one per pair.

Null and empty texts have an empty set and are linked with nothing; a text with
fewer words than a shingle is one shingle. Rows that repeat a doc_id are the same
node. Rows with a null id take no part in links and are kept. Extra columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.numbering import numbered
from kestrel.llm.common import lean, released, small_batches, unused, written
from kestrel.llm.components import components
from kestrel.llm.textblocks import ASCII_LOWER, Block, blocks, mix64, seeded, segment_sums

BANDS, BAND_SIZE = 40, 5
_U = np.uint64
_FRACTION_BITS = 40
_BLOCK = 1 << 18
SMALL_BUCKET = 4096
FILTER_BITS = 1 << 26


def shingle_sets(b: Block, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, limits): the sorted distinct shingle hashes of each document."""
    from kestrel.llm.textblocks import NGRAM_HASH
    hashes = b.word_hashes(ASCII_LOWER)
    grams, at = b.ngrams(hashes, words)
    n = np.maximum(b.n_words - words + 1, 0)
    short = np.flatnonzero((b.n_words > 0) & (b.n_words < words))
    if len(short):
        whole = NGRAM_HASH.slices(NGRAM_HASH.prefix(hashes), b.first_word[short], b.first_word[short + 1])
        grams = np.insert(grams, np.searchsorted(b.word_doc[at], short), whole)
        n[short] = 1
    limits = np.concatenate([[0], np.cumsum(n)])
    for lo, hi in zip(limits[:-1], limits[1:]):
        grams[lo:hi].sort()
    new = np.ones(len(grams), dtype=bool)
    new[1:] = grams[1:] != grams[:-1]
    new[limits[:-1][n > 0]] = True
    return grams[new], np.concatenate([[0], np.cumsum(segment_sums(new, limits))])


def superminhash(elements: np.ndarray, limits: np.ndarray, slots: int) -> np.ndarray:
    """Signature of each set: the smallest (step, fraction) offered to each slot.

    Sets are given one after the other; empty sets keep the largest value.
    """
    n_sets = len(limits) - 1
    sig = np.full(n_sets * slots, np.iinfo(np.uint64).max, dtype=_U)
    owner = np.repeat(np.arange(n_sets), np.diff(limits))
    salts = seeded(slots, 101)
    order = None  # each element's permutation of the slots, as far as it was walked
    live = np.arange(len(elements))
    for step in range(slots):
        if not len(live):
            break
        x = mix64(elements[live] + salts[step])
        pick = step + (((x >> _U(_FRACTION_BITS)) * _U(slots - step)) >> _U(64 - _FRACTION_BITS)).astype(np.int64)
        if step == 0:
            slot = pick
        else:
            rows = np.arange(len(live))
            slot = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[rows, step]
            order[rows, step] = slot
        offer = (_U(step) << _U(_FRACTION_BITS)) | (x & _U((1 << _FRACTION_BITS) - 1))
        np.minimum.at(sig, owner[live] * slots + slot, offer)
        # Later offers are at least step + 1: sets whose slots are all below it are done.
        open_sets = (sig.reshape(n_sets, slots).max(axis=1) >> _U(_FRACTION_BITS)) > step
        going = open_sets[owner[live]]
        if step == 0:
            first_slot, live = slot[going], live[going]
            order = np.broadcast_to(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(live), slots)).copy()
            rows = np.arange(len(live))
            order[rows, first_slot], order[rows, 0] = 0, first_slot
        elif not going.all():
            live, order = live[going], order[going]
    return sig.reshape(n_sets, slots)


def band_keys(sig: np.ndarray, bands: int, size: int) -> np.ndarray:
    """One 64-bit key per set and band; the band number is part of the key."""
    parts = sig.reshape(len(sig), bands, size)
    keys = np.zeros((len(sig), bands), dtype=_U) + seeded(bands, 211)
    for i in range(size):
        keys = mix64(keys ^ parts[:, :, i])
    return keys


_SLOTS_A_WORD = 32


def digests(sig: np.ndarray) -> np.ndarray:
    """Two bits of each slot, packed into words: (sets, words) as int64."""
    bits = mix64(sig) & _U(3)
    wide = np.zeros((len(sig), -(-sig.shape[1] // _SLOTS_A_WORD) * _SLOTS_A_WORD), dtype=_U)
    wide[:, : sig.shape[1]] = bits
    shifts = (2 * np.arange(_SLOTS_A_WORD)).astype(_U)
    return (wide.reshape(len(sig), -1, _SLOTS_A_WORD) << shifts).sum(axis=2, dtype=_U).view(np.int64)


def _digest_words(slots: int) -> int:
    return -(-slots // _SLOTS_A_WORD)


def may_be_similar(x: str, y: str, slots: int, percent: int):
    """Whether two digests agree in as many slots as similar sets do, less seven
    standard deviations: a pair at the limit fails with a chance below 1e-11."""
    differ = F.lit(0)
    for i in range(_digest_words(slots)):
        both = F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))
        odd = both.bitwiseOR(F.shiftrightunsigned(both, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differ = differ + F.bit_count(odd)
    agree = percent / 100 + (1 - percent / 100) / 4
    least = slots * agree - 7 * (slots * agree * (1 - agree)) ** 0.5
    return F.lit(slots) - differ >= F.lit(int(least))


def prints_fit(x: str, y: str, nx: str, ny: str, percent: int):
    """Whether two sets can be similar enough, from the distinct 16-bit prints of
    their elements. Of the common elements at most as many are lost as either set
    loses to equal prints, so no similar pair fails."""
    lost = F.least(F.col(nx) - F.size(x), F.col(ny) - F.size(y))
    return (100 + percent) * (F.size(F.array_intersect(x, y)) + lost) >= percent * (F.col(nx) + F.col(ny))


_SIGNED = "n_shingles bigint, set_hi bigint, set_lo bigint, bands array<bigint>, digest array<bigint>"


def _sign_batches(words: int, bands: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for b in blocks(batch.column(1), _BLOCK):
                hashes, limits = shingle_sets(b, words)
                n = np.diff(limits)
                sums = []
                for seed in (_U(3), _U(5)):
                    total = np.zeros(len(hashes) + 1, dtype=_U)
                    np.cumsum(mix64(hashes * seed + seed), dtype=_U, out=total[1:])
                    sums.append(mix64(total[limits[1:]] - total[limits[:-1]] + n.astype(_U)).view(np.int64))
                sig = superminhash(hashes, limits, bands * size)
                lists = [_lists(band_keys(sig, bands, size).view(np.int64), n > 0), _lists(digests(sig), n > 0)]
                yield pa.RecordBatch.from_arrays([ids[b.rows], pa.array(n), pa.array(sums[0]), pa.array(sums[1]), *lists],
                                                 names=["doc_id", "n_shingles", "set_hi", "set_lo", "bands", "digest"])
    return run


def _lists(rows: np.ndarray, keep: np.ndarray) -> pa.ListArray:
    """One list per row, empty where it is not kept."""
    offsets = np.concatenate([[0], np.cumsum(np.where(keep, rows.shape[1], 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows[keep].ravel()))


def _prints(hashes: np.ndarray, limits: np.ndarray) -> pa.ListArray:
    """The distinct 16-bit prints of each set; elements come sorted."""
    top = (hashes >> _U(48)).astype(np.uint16)
    new = np.ones(len(top), dtype=bool)
    new[1:] = top[1:] != top[:-1]
    new[limits[:-1][np.diff(limits) > 0]] = True
    offsets = np.concatenate([[0], np.cumsum(segment_sums(new, limits))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(top[new].view(np.int16)))


def _slot(ids: np.ndarray) -> np.ndarray:
    return (mix64(ids.astype(np.int64).view(_U)) & _U(FILTER_BITS - 1)).astype(np.int64)


def _filter_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node) to the words of a bit filter that they set."""
    words = np.zeros(FILTER_BITS // 64, dtype=_U)
    for batch in batches:
        slot = _slot(batch.column(0).to_numpy(zero_copy_only=False))
        np.bitwise_or.at(words, slot >> 6, _U(1) << (slot & 63).astype(_U))
    at = np.flatnonzero(words)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at].view(np.int64))], names=["at", "word"])


def _id_filter(ids: DataFrame) -> np.ndarray:
    """A bit filter of fixed size that holds all ids: ``FILTER_BITS`` bits, of which
    8 MB reach the driver however many ids there are. Other ids pass it by chance."""
    rows = (ids.mapInArrow(lean(_filter_batches), "at bigint, word bigint").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow())
    words = np.zeros(FILTER_BITS // 64, dtype=_U)
    words[rows.column("at").to_numpy()] = rows.column("word").to_numpy().view(_U)
    return words


def _where_in(rows: DataFrame, column: str, wanted: np.ndarray, passing: bool = True) -> DataFrame:
    """The rows whose ``column`` passes the filter, or the others, without a shuffle.
    A null does not pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(column)
            slot = _slot(ids.fill_null(0).to_numpy(zero_copy_only=False))
            hit = ((wanted[slot >> 6] >> (slot & 63).astype(_U)) & _U(1) != 0) & np.asarray(ids.is_valid())
            yield batch.filter(pa.array(hit == passing))
    return rows.mapInArrow(lean(run), rows.schema)


def _wanted_sets(batches: Iterator[pa.RecordBatch], words: int, wanted: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(ids, hashes, limits) of the documents whose id passes the filter."""
    for batch in batches:
        batch = batch.filter(pa.compute.is_valid(batch.column(0)))
        slot = _slot(batch.column(0).to_numpy(zero_copy_only=False))
        batch = batch.filter(pa.array((wanted[slot >> 6] >> (slot & 63).astype(_U)) & _U(1) != 0))
        for b in blocks(batch.column(1), _BLOCK):
            yield batch.column(0)[b.rows], *shingle_sets(b, words)


def _set_batches(words: int, wanted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, limits in _wanted_sets(batches, words, wanted):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.ListArray.from_arrays(pa.array(limits.astype(np.int32)), pa.array(hashes.view(np.int64)))],
                names=["node", "shingles"])
    return run


def _print_batches(words: int, wanted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, limits in _wanted_sets(batches, words, wanted):
            yield pa.RecordBatch.from_arrays([ids, _prints(hashes, limits)], names=["node", "prints"])
    return run


class _Verifier:
    """Exact similarity of candidate pairs. The shingle sets of the nodes concerned
    are made from their texts when a pair first needs them, in a scan that tests each
    id against a filter of fixed size; the texts themselves are never shuffled, and
    sets that pass the filter by chance fall out in the join. So are the prints, which
    few documents need and which would be most of the signatures."""

    def __init__(self, rows: DataFrame, words: int, percent: int):
        self.rows, self.words, self.percent = rows, words, percent
        self.sets: DataFrame | None = None

    def prints(self, ids: DataFrame, passes: np.ndarray) -> DataFrame:
        """(node, prints) of the nodes ``ids``, all of which are in the filter."""
        made = self.rows.mapInArrow(lean(_print_batches(self.words, passes)), "node bigint, prints array<smallint>")
        return made.where(F.size("prints") > 0).join(ids, "node")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (x, y) whose full sets are similar enough."""
        wanted = pairs.select(F.col("x").alias("node")).union(pairs.select("y")).distinct()
        if self.sets is not None:
            wanted = written(wanted.join(self.sets.select("node"), "node", "left_anti"), "wanted")
        if self.sets is None or not wanted.isEmpty():
            passed = self.rows.mapInArrow(lean(_set_batches(self.words, _id_filter(wanted))), "node bigint, shingles array<bigint>")
            made = written(passed.join(wanted, "node", "left_semi"), "sets")
            self.sets = made if self.sets is None else self.sets.union(made)
        with_x = pairs.join(self.sets.select(F.col("node").alias("x"), F.col("shingles").alias("sx")), "x")
        with_y = with_x.join(self.sets.select(F.col("node").alias("y"), F.col("shingles").alias("sy")), "y")
        both, nx, ny = F.size(F.array_intersect("sx", "sy")), F.size("sx"), F.size("sy")
        # No grouping behind the join, so that Spark can split a node with many pairs.
        return written(with_y.where(100 * both >= self.percent * (nx + ny - both)).select("x", "y"), "verified")


def _sizes_fit(nx, ny, percent: int):
    """Sets whose sizes differ more than this cannot be similar enough."""
    return F.least(nx, ny) * 100 >= percent * F.greatest(nx, ny)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                    percent: int = 80, bands: int = BANDS, band_size: int = BAND_SIZE, pivots: int = 1024) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest id
    reachable over links of at least ``percent`` percent similarity) and kept."""
    spark = df.sparkSession
    small_batches(spark)
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    with released(spark):
        signed = written(rows.mapInArrow(lean(_sign_batches(shingle_words, bands, band_size)), f"doc_id bigint, {_SIGNED}"), "signatures")
        filled = signed.where("n_shingles > 0 and doc_id is not null")
        # One node per distinct set.
        nodes = written(filled.groupBy("set_hi", "set_lo").agg(
            F.min("doc_id").alias("node"), F.min_by("bands", "doc_id").alias("bands"), F.min_by("digest", "doc_id").alias("digest"),
            F.min("n_shingles").alias("n")), "nodes")
        labels = _node_components(nodes, _Verifier(rows, shingle_words, percent), bands * band_size, percent, pivots)
        named = nodes.select("set_hi", "set_lo", "node").join(labels, "node", "left").select(
            "set_hi", "set_lo", F.coalesce("component", "node").alias("component"))
        out = signed.drop("bands", "digest").join(named, ["set_hi", "set_lo"], "left")
        alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
        component = F.when(alone, F.col("doc_id")).otherwise(F.col("component"))
        return written(out.select("doc_id", "n_shingles", component.alias("component_id"),
                                  F.col("doc_id").eqNullSafe(component).alias("kept")), "near-duplicates", keep=True)


def one_of_each_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that are kept, with their own columns: one document of each
    group. Rows that share an id and differ in their texts are documents of their own;
    of rows that share both, the one with the smallest hash of all columns stays. Rows
    with a null id stay."""
    small_batches(df.sparkSession)
    known = df.where(F.col(f"`{id_col}`").isNotNull())
    ids = known.agg(F.count("*").alias("n"), F.count_distinct(F.col(f"`{id_col}`")).alias("d")).first()
    if ids["n"] == ids["d"]:
        gone, key = unused(df, "_gone"), unused(df, "_key")
        found = near_duplicates(df, id_col, text_col, **options).where("not kept").select(F.col("doc_id").alias(gone))
        passes = _id_filter(found)
        keyed = df.withColumn(key, F.col(f"`{id_col}`").cast("bigint"))
        # What does not pass is not gone; only the texts that pass meet the ids.
        sure = _where_in(keyed, key, passes, passing=False)
        rest = _where_in(keyed, key, passes).join(found, F.col(key) == F.col(gone), "left_anti")
        return sure.unionByName(rest).drop(key)
    # Number the distinct (id, text); equal hashes of equal ids are equal texts.
    of = lambda rows: (F.col(f"`{id_col}`").cast("bigint").alias("id"), F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary"), 256).alias("h"),
                       F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    keyed = known.select(F.struct(*of(known)).alias("key"), F.col(f"`{text_col}`").alias("text"))
    firsts = keyed.groupBy("key.id", "key.h").agg(F.min("key.row").alias("row"))
    names = written(numbered(firsts, ["id", "h"], "number"), "document-numbers")
    texts = keyed.dropDuplicates(["key"]).join(names.select(F.struct("id", "h", "row").alias("key"), "number"), "key")
    texts = written(texts.select("number", "text"), "numbered-texts")    # read several times
    kept = near_duplicates(texts, "number", "text", **options).where("kept").select(F.col("doc_id").alias("number"))
    stay = names.join(kept, "number").select(F.struct("id", "h", "row").alias("key"))
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("record")
    rows = known.select(record, F.struct(*of(known)).alias("key")).join(stay, "key", "left_semi").dropDuplicates(["key"])
    return rows.select("record.*").unionByName(df.where(F.col(f"`{id_col}`").isNull()))


def _node_components(nodes: DataFrame, verifier: _Verifier, slots: int, percent: int, pivots: int) -> DataFrame:
    members = nodes.select(F.explode("bands").alias("key"), "node", "n")
    crowded = written(members.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most").drop("most"), "crowded")
    # Members of buckets with two nodes or more; most nodes have none.
    shared = written(_where_in(members, "key", _id_filter(crowded.select("key"))).join(crowded, "key"), "buckets")
    digest = nodes.select("node", "digest", "n")
    stars = shared.where("node <> least").select(F.col("node").alias("x"), F.col("least").alias("y")).distinct()
    seen = (stars.join(digest.select(F.col("node").alias("x"), F.col("digest").alias("dx"), F.col("n").alias("nx")), "x")
            .join(digest.select(F.col("node").alias("y"), F.col("digest").alias("dy"), F.col("n").alias("ny")), "y"))
    likely = written(seen.where(may_be_similar("dx", "dy", slots, percent) & _sizes_fit(F.col("nx"), F.col("ny"), percent))
                     .select("x", "y", "nx", "ny"), "likely")
    ends = written(likely.select(F.col("x").alias("node")).union(likely.select("y")).distinct(), "ends")
    own = written(verifier.prints(ends, _id_filter(ends)), "prints")
    near = (likely.join(own.select(F.col("node").alias("x"), F.col("prints").alias("px")), "x")
            .join(own.select(F.col("node").alias("y"), F.col("prints").alias("py")), "y"))
    tried = written(near.where(prints_fit("px", "py", "nx", "ny", percent)).select("x", "y"), "pairs")
    links = verifier.links(tried)
    labels = components(links, "x", "y")
    outside, rest = _mixed_buckets(shared, digest, verifier, labels)
    compared = None  # (key, node) of the pivots so far
    while True:
        # All of a small bucket's at once, ``pivots`` at a time of a large one's.
        slot = F.when(F.col("total") <= SMALL_BUCKET, F.col("node")).otherwise(F.pmod(F.hash("node"), F.lit(pivots)))
        left = outside if compared is None else outside.join(compared, ["key", "node"], "left_anti")
        chosen = written(left.groupBy("key", slot.alias("slot")).agg(F.min("node").alias("node")).select("key", "node"), "pivots")
        if chosen.isEmpty():
            return labels
        ask = chosen.join(rest, ["key", "node"]).select(
            F.col("key").alias("pk"), F.col("node").alias("p"), F.col("n").alias("pn"), F.col("c").alias("pc"), F.col("digest").alias("pd"), F.col("prints").alias("pp"))
        # Digests and prints are compared inside the join: hardly a pair comes out
        # that is not similar.
        likely = ((F.col("key") == F.col("pk")) & (F.col("c") != F.col("pc")) & _sizes_fit(F.col("n"), F.col("pn"), percent)
                  & may_be_similar("digest", "pd", slots, percent) & prints_fit("prints", "pp", "n", "pn", percent))
        pairs = ask.join(rest, likely).select(F.greatest("p", "node").alias("x"), F.least("p", "node").alias("y")).distinct()
        more = written(pairs.join(tried, ["x", "y"], "left_anti"), "pairs")
        compared = chosen if compared is None else compared.union(chosen)
        if more.isEmpty():
            continue
        tried = tried.union(more)
        found = verifier.links(more)
        if not found.isEmpty():
            links = links.union(found)
            labels = components(links, "x", "y")
            outside, rest = _mixed_buckets(shared, digest, verifier, labels)


def _mixed_buckets(shared: DataFrame, digest: DataFrame, verifier: _Verifier, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Buckets whose nodes lie in several groups: the nodes outside the bucket's
    largest group, and all nodes with their group, digest and prints."""
    marked = shared.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("c"))
    groups = marked.groupBy("key", "c").agg(F.count("*").alias("size"))
    # Two nodes alone were compared in the first round.
    mixed = (groups.groupBy("key").agg(F.count("*").alias("k"), F.max_by("c", F.struct("size", "c")).alias("largest"), F.sum("size").alias("total"))
             .where("k > 1 and total > 2"))
    chosen = written(marked.join(mixed.select("key", "largest", "total"), "key"), "mixed")
    wanted = written(chosen.select("node").distinct(), "mixed-nodes")
    passes = _id_filter(wanted)
    own = verifier.prints(wanted, passes).join(_where_in(digest, "node", passes), "node")
    rest = written(chosen.join(own, "node"), "mixed")
    return rest.where("c <> largest").select("key", "node", "total"), rest
