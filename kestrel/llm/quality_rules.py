"""Quality rules with adaptive limits (operator 6).

1. One numpy pass per text (``text_measures``) counts words, symbols, repeated
   lines and repeated three-word windows.
2. Each measure is summarised per language and source by a mergeable quantile
   sketch: counts of logarithmic buckets with a fixed relative error. Sketches
   merge by adding counts, so the language sketch is the sum of its sources'
   sketches and the corpus sketch the sum of the languages'.
3. Limits come from the sketch of the narrowest level that holds at least
   ``min_docs`` documents: the 90th percentile plus ``reach`` times its distance
   to the median, but at least the 95th percentile; the same downwards for word
   length. They replace fixed cutoffs: where 95 of 100 texts have no symbol, the
   limit is none.
4. The measures are joined with their limits. A text fails if it is beyond one by
   more than the error of the sketch and, for a share, more than ``NOISE`` standard
   deviations of a count in a text of its length, so that one symbol in a long text
   does not reject it.

Null and empty texts have no words and fail the base rule. Null languages and
sources form groups of their own. Repeated rows are judged one by one. An empty
table gives an empty result. Columns other than the named ones are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kestrel.llm.common import with_arrays, extended, written
from kestrel.llm.textblocks import _SPACE, Block, Roller, blocks, mix64, segment_sums

SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 3
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

_LINE_HASH = Roller(37)
_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_U = np.uint64


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Mask of the keys that occur at least twice."""
    order = np.sort(keys)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def _per_document(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes made distinct between the documents of a block."""
    return mix64(hashes + mix64(doc.astype(_U) + _U(1)))


def _measure(b: Block) -> dict[str, np.ndarray]:
    limits = np.append(b.doc_start, b.doc_end[-1:]) if b.n_docs else np.zeros(1, dtype=np.int64)
    inside = ~_SPACE[b.data]
    starts_char = (b.data & 0xC0) != 0x80
    out = {
        "n_words": b.n_words,
        "word_chars": segment_sums(inside & starts_char, limits),
        "n_symbols": segment_sums(_IS_SYMBOL[b.data], limits),
    }
    # Repeated windows of words.
    covered = np.zeros(len(b.word_start) + REPEAT_WINDOW, dtype=bool)
    grams, at = b.ngrams(b.word_hashes(), REPEAT_WINDOW)
    twice = at[_repeats(_per_document(grams, b.word_doc[at]))]
    for k in range(REPEAT_WINDOW):
        covered[twice + k] = True
    out["n_repeat_words"] = segment_sums(covered[: len(b.word_start)], b.first_word)
    # Lines: runs between line feeds and document limits.
    breaks = np.flatnonzero(b.data == 0x0A)
    start = np.sort(np.concatenate([b.doc_start, breaks + 1]), kind="stable")
    end = np.sort(np.concatenate([b.doc_end, breaks]), kind="stable")
    # The k-th start pairs with the k-th end: both lists hold one limit per line.
    words_before = np.zeros(len(b.data) + 1, dtype=np.int64)
    np.cumsum(inside, out=words_before[1:])
    some = words_before[end] > words_before[start]
    start, end = start[some], end[some]
    doc = np.searchsorted(b.doc_start, start, side="right") - 1
    prefix = _LINE_HASH.prefix(_LINE_HASH.table[b.data])
    keys = _per_document(_LINE_HASH.slices(prefix, start, end), doc)
    again = np.zeros(len(keys), dtype=bool)
    maybe = np.flatnonzero(_repeats(keys))
    if len(maybe):
        _, first = np.unique(keys[maybe], return_index=True)
        again[maybe] = True
        again[maybe[first]] = False
    out["n_dup_lines"] = np.bincount(doc[again], minlength=b.n_docs)
    out["n_lines"] = np.bincount(doc, minlength=b.n_docs)
    return out


def _measure_batches(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_measure(b) for b in blocks(batch.column(text_col))]
            got = {m: pa.array(np.concatenate([p[m] for p in parts]) if parts else np.empty(0, dtype=np.int64),
                               type=pa.int64()) for m in MEASURES}
            yield with_arrays(batch.drop_columns([text_col]), **got)
    return run


def text_measures(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows without their text and with the columns of ``MEASURES``."""
    schema = extended(df.drop(text_col), **{m: _long() for m in MEASURES})
    return df.mapInArrow(_measure_batches(text_col), schema)


def _long():
    from pyspark.sql import types as T
    return T.LongType()


def shares() -> dict[str, Column]:
    """The measures that get limits, as columns over ``MEASURES``."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "word_length": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
    }


# Of each share: what is counted, out of how many, and how many come at once (a
# repeated window counts its words twice).
COUNTS = {"symbol_share": ("n_symbols", "n_words", 1), "dup_line_share": ("n_dup_lines", "n_lines", 1),
          "repeat_share": ("n_repeat_words", "n_words", 2 * REPEAT_WINDOW)}
LIMITED = ("word_length", *COUNTS)
NOISE = 4.0   # standard deviations that a count may exceed its limit by chance
TWO_SIDED = ("word_length",)


def sketch_counts(measured: DataFrame, groups: tuple[str, ...], error: float = 0.01) -> DataFrame:
    """Quantile sketches: (groups, measure, bucket, n). Zero has the bucket null-safe lowest."""
    step = math.log((1 + error) / (1 - error))
    long = measured.select(*groups, F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), c.alias("value")) for m, c in shares().items()])).alias("s"))
    value = F.col("s.value")
    bucket = F.when(value < 1e-4, F.lit(-1_000_000)).otherwise(F.ceil(F.log(value) / step)).cast("int")
    return long.groupBy(*groups, F.col("s.measure").alias("measure"), bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merged(sketches: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """Sketches of wider groups: counts add up."""
    return sketches.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, groups: tuple[str, ...], probs: dict[str, float], error: float = 0.01) -> DataFrame:
    """One row per group and measure: total and the named quantiles."""
    step = math.log((1 + error) / (1 - error))
    per = W.partitionBy(*groups, "measure")
    seen = F.sum("n").over(per.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
    value = F.when(F.col("bucket") == -1_000_000, F.lit(0.0)).otherwise(2 * F.exp(F.col("bucket") * step) / (math.exp(step) + 1))
    ranked = sketches.withColumn("seen", seen).withColumn("total", F.sum("n").over(per)).withColumn("value", value)
    picks = [F.min(F.when(F.col("seen") >= p * F.col("total"), F.col("value"))).alias(name) for name, p in probs.items()]
    return ranked.groupBy(*groups, "measure").agg(F.max("total").alias("total"), *picks)


QUANTILES = {"q05": 0.05, "q10": 0.1, "q50": 0.5, "q90": 0.9, "q95": 0.95}


def _limits(q: DataFrame, groups: tuple[str, ...], reach: float, tag: str) -> DataFrame:
    """One row per group: docs and, per measure, its lower and upper limit."""
    up = F.greatest(F.col("q95"), F.col("q90") + reach * (F.col("q90") - F.col("q50")))
    down = F.when(F.col("measure").isin(*TWO_SIDED), F.least(F.col("q05"), F.col("q10") - reach * (F.col("q50") - F.col("q10"))))
    aggs = [F.max("total").alias(f"{tag}_docs")]
    for m in LIMITED:
        aggs += [F.max(F.when(F.col("measure") == m, up)).alias(f"{tag}_{m}_hi"),
                 F.max(F.when(F.col("measure") == m, down)).alias(f"{tag}_{m}_lo")]
    return q.groupBy(*groups).agg(*aggs)


def _beyond(measure: str, error: float) -> Column:
    """Whether a text lies outside the limits in the columns <measure>_hi and _lo, by
    more than the error of the sketch and, for a share, than its count varies by chance
    in a text of that length."""
    hi, lo = F.col(f"{measure}_hi"), F.col(f"{measure}_lo")
    if measure not in COUNTS:
        value = shares()[measure]
        return (value > hi * (1 + 2 * error)) | F.coalesce(value < lo * (1 - 2 * error), F.lit(False))
    k, n, clump = COUNTS[measure]
    expected = hi * (1 + 2 * error) * F.col(n)
    return F.col(k) > expected + NOISE * F.sqrt(clump * (expected + clump))


def quality_verdicts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     source_col: str = "source", reach: float = 4.0, min_docs: int = 100,
                     least_words: int = 50, repeat_percent: int = 50, error: float = 0.01) -> DataFrame:
    """Measures, limits and verdict of every text.

    Returns one row per input row: the id, the measures, ``base_failed`` (fewer than ``least_words`` words, or more than
    ``repeat_percent`` percent of them in repeated windows), ``beyond`` (measures
    outside their adaptive limits, comma-joined) and ``kept``.
    """
    narrow = df.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"),
                       F.col(source_col).alias("_source"), F.col(text_col).alias("_text"))
    measured = written(text_measures(narrow, "_text"), "quality-measures")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    # Sketches describe texts that pass the base rule; the others are rejected anyway.
    sound = measured.where(~failed)
    fine = written(sketch_counts(sound, ("_lang", "_source"), error), "quality-sketches")
    by_lang = merged(fine, ("_lang",))
    whole = merged(fine, ())
    of_source = _limits(quantiles(fine, ("_lang", "_source"), QUANTILES, error), ("_lang", "_source"), reach, "s")
    of_lang = _limits(quantiles(by_lang, ("_lang",), QUANTILES, error), ("_lang",), reach, "l")
    of_all = _limits(quantiles(whole, (), QUANTILES, error), (), reach, "a")
    bounds = [f"{m}_{e}" for m in LIMITED for e in ("lo", "hi")]
    row = of_all.first()  # one row: the limits of the whole corpus
    fallback = {b: F.lit(row[f"a_{b}"] if row else None).cast("double") for b in bounds}
    s, l = of_source.alias("s"), of_lang.alias("l")
    limits = (s.join(l, F.col("s._lang").eqNullSafe(F.col("l._lang")))
              .select(F.col("s._lang").alias("g_lang"), F.col("s._source").alias("g_source"),
                      *[F.when(F.col("s_docs") >= min_docs, F.col(f"s_{b}"))
                        .when(F.col("l_docs") >= min_docs, F.col(f"l_{b}"))
                        .otherwise(fallback[b]).alias(b) for b in bounds]))
    joined = measured.join(limits, F.col("_lang").eqNullSafe(F.col("g_lang")) & F.col("_source").eqNullSafe(F.col("g_source")), "left")
    outside = [F.when(_beyond(m, error), F.lit(m)) for m in LIMITED]
    return (joined.select(F.col("_id").alias(id_col), *MEASURES, failed.alias("base_failed"),
                          F.concat_ws(",", *outside).alias("beyond"))
            .withColumn("kept", ~F.col("base_failed") & (F.col("beyond") == "")))
