"""Source divergence audit by pair-task sparse merges (operator 11).

How far do the sources of a language use its words differently? Terms are maximal
runs of ASCII letters and non-ASCII characters, with only A-Z lower-cased. A language
keeps the terms that at least ``least_docs`` of its documents hold. Every (language,
source) group and every language gives each kept term a smoothed whole-number share

    p = 1 + floor(SCALE * (count + 2) / (N + 2 * V))

(N: occurrences of kept terms, V: kept terms), and two shares differ by
f = floor((p - q)^2 / (p + q)).

``Audit.pair_divergence`` sums f over all kept terms for every two sources of a language.
Terms are dealt by hash to slices of bounded size; in a slice a group is one sparse
vector, sorted (term id, count) arrays. Sources are dealt to blocks, and a task
co-groups the vectors of two blocks in one slice, so a vector is sent once per block
and not once per pair. For each unordered pair a galloping intersection finds the
overlap; overlapping, one-sided and absent terms are priced apart, and as f is
symmetric the sum holds both ways. Sums over the slices follow in Spark.

``Audit.term_divergence`` compares a group with its language term by term.

All arithmetic is on whole numbers: decimals in SQL, and in the tasks a long division
in steps of 1,000, so nothing overflows below 9e15 occurrences.

Counting is one pass over the texts: tasks sum occurrences and documents per
(language, source, term) before anything is shuffled, so frequent terms are one row
a task. Null texts, languages and sources count as ''. Groups without a kept term
take part with zero counts; a language that keeps no term has pairs of value 0 and no
terms. Repeated rows are documents of their own. Very long texts are read in pieces.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kestrel.llm.common import written
from kestrel.llm.textblocks import byte_blocks

SCALE = 1_000_000_000
LEAST_DOCS = 10
TERM_RANKS = 10
SLICE_ROWS = 200_000    # (source, term) rows of a language in one slice, about
LEAST_SLICES = 16
BLOCK_SOURCES = 8       # sources whose vectors one task holds, on either side
_STEPS = (1000, 1000, 1000)  # their product is SCALE
GALLOP = 256            # terms of the shorter vector that move on together
FLUSH = 400_000         # terms that a task holds before it hands them on
PIECE = 1 << 20         # bytes of a text that are read at once

_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of one lower-cased text. A long text is cut where no term is cut."""
    at = 0
    while at < len(text):
        cut = _BREAK.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        yield _TERM.findall(text, at, end)
        at = end


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, text) to occurrences and documents per group and term."""
    sums: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

    def flush():
        for (lang, source), (n, docs) in sums.items():
            terms = pa.array(list(n), pa.binary()).cast(pa.string())
            same = [pa.array([x], pa.string()).take(pa.array(np.zeros(len(n), dtype=np.int32))) for x in (lang, source)]
            yield pa.RecordBatch.from_arrays([*same, terms, pa.array(list(n.values()), pa.int64()),
                                              pa.array([docs[t] for t in n], pa.int64())], schema=_COUNTS)
        sums.clear()

    held = 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for rows, data, offs in byte_blocks(batch.column(2)):
            raw = data.tobytes().lower()  # of bytes: A-Z only
            for k in range(len(offs) - 1):
                n, docs = sums[langs[rows.start + k], sources[rows.start + k]]
                held -= len(n)
                seen: set[bytes] = set()
                for terms in terms_of(raw[offs[k]: offs[k + 1]]):
                    n.update(terms)
                    seen.update(terms)
                docs.update(seen)
                held += len(n)
            if held > FLUSH:
                yield from flush()
                held = 0
    yield from flush()


def term_counts(rows: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of rows (lang, source, text)."""
    counts = rows.mapInArrow(_count_batches, "lang string, source string, term string, n bigint, docs bigint")
    return counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, vocabulary: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * vocabulary)); null without a vocabulary."""
    scaled = (count + 2).cast("decimal(20,0)") * F.lit(SCALE)
    return F.call_function("div", scaled, F.nullif(total + 2 * vocabulary, F.lit(0))) + 1


def shares(counts: np.ndarray, total: int, vocabulary: int) -> np.ndarray:
    """``share`` of an array of counts, digits by threes."""
    left, whole = counts + 2, total + 2 * vocabulary
    quotient = np.zeros_like(left)
    for factor in (1, *_STEPS):
        part = left * factor
        quotient = quotient * factor + part // whole
        left = part % whole
    return quotient + 1


def divergence(p, q):
    """floor((p - q)^2 / (p + q)) of arrays or whole numbers."""
    return (p - q) * (p - q) // (p + q)


def galloped(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``a`` and in ``b`` of the values that both sorted arrays hold.

    The shorter array moves on ``GALLOP`` values at a time; in the longer one the end
    of their stretch is found by steps that double from the end of the last stretch,
    and only the stretch is searched.
    """
    if len(a) > len(b):
        there, here = galloped(b, a)
        return here, there
    in_a, in_b, at = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)], 0
    for lo in range(0, len(a), GALLOP):
        few = a[lo: lo + GALLOP]
        step = GALLOP
        while at + step < len(b) and b[at + step] < few[-1]:
            step *= 2
        stretch = b[at: at + step + 1]
        place = np.searchsorted(stretch, few)
        hit = place < len(stretch)
        hit[hit] = stretch[place[hit]] == few[hit]
        in_a.append(lo + np.flatnonzero(hit))
        in_b.append(at + place[hit])
        at += int(place[-1])
        if at >= len(b):
            break
    return np.concatenate(in_a), np.concatenate(in_b)


def pair_value(a: tuple, b: tuple, vocabulary: int, terms: int) -> int:
    """Sum of the divergences of two sparse vectors (ids, counts, total) over the
    ``terms`` kept terms of a slice; ``vocabulary`` counts those of all slices."""
    if not vocabulary:
        return 0
    (ids_a, n_a, total_a), (ids_b, n_b, total_b) = a, b
    p, q = shares(n_a, total_a, vocabulary), shares(n_b, total_b, vocabulary)
    p0, q0 = (int(shares(np.zeros(1, dtype=np.int64), t, vocabulary)[0]) for t in (total_a, total_b))
    in_a, in_b = galloped(ids_a, ids_b)
    only_a, only_b = divergence(p, q0), divergence(p0, q)
    both = divergence(p[in_a], q[in_b]).sum()
    absent = terms - len(ids_a) - len(ids_b) + len(in_a)
    return int(both + only_a.sum() - only_a[in_a].sum() + only_b.sum() - only_b[in_b].sum()) + absent * divergence(p0, q0)


def _vectors(table: pa.Table) -> list[tuple]:
    """(ordinal, source, vector) of the rows of one block."""
    columns = [table.column(c).to_pylist() for c in ("ordinal", "source", "total")]
    lists = []
    for c in ("ids", "counts"):
        merged = table.column(c).combine_chunks()
        values, ends = merged.flatten().to_numpy(), np.cumsum([0, *(len(x) for x in merged)])
        lists.append([values[lo:hi] for lo, hi in zip(ends[:-1], ends[1:])])
    return [(o, s, (ids, n, t)) for o, s, t, ids, n in zip(*columns, *lists)]


_PAIRS = "lang string, a string, b string, value bigint"


def _price_blocks(left: pa.Table, right: pa.Table) -> pa.Table:
    """All unordered pairs of a source of the left block and one of the right block."""
    out: dict[str, list] = {"a": [], "b": [], "value": []}
    lang = (left if left.num_rows else right).column("lang")[0].as_py() if left.num_rows + right.num_rows else ""
    sides = (_vectors(left), _vectors(right)) if left.num_rows and right.num_rows else ((), ())
    if sides[0]:
        vocabulary, terms = left.column("vocabulary")[0].as_py(), left.column("terms")[0].as_py()
    for rank_a, a, vector_a in sides[0]:
        for rank_b, b, vector_b in sides[1]:
            if rank_a < rank_b:
                out["a"].append(a)
                out["b"].append(b)
                out["value"].append(pair_value(vector_a, vector_b, vocabulary, terms))
    n = len(out["a"])
    return pa.table({"lang": pa.array([lang] * n, pa.string()), "a": pa.array(out["a"], pa.string()),
                     "b": pa.array(out["b"], pa.string()), "value": pa.array(out["value"], pa.int64())})


class Audit:
    """The kept counts of a table, written once; both reports follow from them.

    ``kept``: (lang, source, slice, id, term, n, lang_n), where the id is the rank of
    the term in its slice. ``groups``: (lang, source, total, lang_total, vocabulary).
    ``slices``: (lang, slice, terms).
    """

    def __init__(self, df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                 least_docs: int = LEAST_DOCS, slice_rows: int = SLICE_ROWS):
        rows = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a)
                           for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
        counts = written(term_counts(rows), "term-counts")
        crowd = counts.groupBy("lang").count().agg(F.max("count").alias("m")).first()["m"] or 0
        self.n_slices = max(LEAST_SLICES, math.ceil(crowd / slice_rows))
        term = W.partitionBy("lang", "slice", "term")
        self.kept = written(
            counts.withColumn("slice", F.pmod(F.xxhash64("term"), F.lit(self.n_slices)).cast("int"))
            .withColumn("id", F.dense_rank().over(W.partitionBy("lang", "slice").orderBy("term")))
            .withColumn("lang_n", F.sum("n").over(term)).withColumn("lang_docs", F.sum("docs").over(term))
            .where(F.col("lang_docs") >= least_docs).drop("docs", "lang_docs"), "kept-terms")
        self.slices = self.kept.groupBy("lang", "slice").agg(F.count_distinct("id").alias("terms"))
        languages = (self.slices.groupBy("lang").agg(F.sum("terms").alias("vocabulary"))
                     .join(self.kept.groupBy("lang").agg(F.sum("n").alias("lang_total")), "lang"))
        totals = self.kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        self.groups = written(rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
                              .join(languages, "lang", "left").na.fill(0, ["total", "vocabulary", "lang_total"]), "term-groups")

    def term_divergence(self, ranks: int = TERM_RANKS) -> DataFrame:
        """(lang, source, item, value, rank): the terms that a group uses most beyond
        its language's share."""
        both = (self.kept.join(self.groups, ["lang", "source"])
                .withColumn("p", share(F.col("n"), F.col("total"), F.col("vocabulary")))
                .withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("vocabulary"))).where("p > q"))
        value = F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("p") + F.col("q"))
        return _ranked(both.select("lang", "source", F.col("term").alias("item"), value.alias("value"))).where(F.col("rank") <= ranks)

    def pair_divergence(self, block_sources: int = BLOCK_SOURCES) -> DataFrame:
        """(lang, source, item, value, rank): every other source of the language."""
        ordinal = F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1
        blocks = F.ceil(F.count("*").over(W.partitionBy("lang")) / block_sources).cast("int")
        placed = (self.groups.withColumn("ordinal", ordinal).withColumn("blocks", blocks)
                  .withColumn("block", F.floor(F.col("ordinal") / block_sources).cast("int"))
                  .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(self.n_slices - 1)))))
        cells = self.kept.groupBy("lang", "slice", "source").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("cells"))
        vectors = placed.join(cells, ["lang", "slice", "source"], "left").join(self.slices, ["lang", "slice"], "left")
        cell = F.coalesce("cells", F.array().cast("array<struct<id:int,n:bigint>>"))
        vectors = written(vectors.select("lang", "slice", "source", "ordinal", "block", "blocks", "total", "vocabulary",
                                         F.coalesce("terms", F.lit(0)).alias("terms"), cell["id"].alias("ids"), cell["n"].alias("counts")), "term-vectors")
        left = vectors.withColumn("i", F.col("block")).withColumn("j", F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)))
        right = vectors.withColumn("j", F.col("block")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("block"))))
        task = ["lang", "slice", "i", "j"]
        parts = left.groupBy(*task).cogroup(right.groupBy(*task)).applyInArrow(_price_blocks, _PAIRS)
        sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
        ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                 F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("way")
        return _ranked(sums.select("lang", ways, "value").select("lang", "way.source", "way.item", "value"))


def _ranked(rows: DataFrame) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(order))
