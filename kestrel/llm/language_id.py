"""Language identification by rank-order profiles (operator 2).

A profile is the list of the most frequent letter n-grams (one to three letters,
word limits marked by a blank), ordered by falling count. A document's profile
is compared with each language's by the out-of-place distance: the sum, over the
document's n-grams, of the difference of ranks, and the profile length where the
language lacks the n-gram. The nearest language wins, ties go to the smaller
name.

The language profiles are counted over all training documents: each task sums
n-gram counts per language, Spark adds them, and the top of each language is
found per slice of n-grams before the slices meet.

Letters are code points of Unicode category L, lower-cased. A text that is null
or has no letter is ``und`` with score 0. With no learned language every text is
``und``. Repeated rows get equal answers, an empty table an empty result, and
input columns that carry the names of the two new ones are replaced.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from kestrel.llm.common import extended, lean, with_arrays
from kestrel.llm.textblocks import byte_blocks

PROFILE_SIZE = 300
UNDETERMINED = "und"
_SLICES = 16
_FLUSH = 400_000
_BLOCK = 1 << 19        # bytes of text whose n-grams are made at once
_U = np.uint64


@functools.cache
def _letters() -> np.ndarray:
    """Per code point: its lower-case letter, or 0 if it is no letter."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def _letter_runs(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of a block with each run of other characters as one 0, and the
    limits of its documents in that array. Each document begins and ends with 0."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    lead = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    limits = lead[offs]
    codes = _letters()[points]
    # One extra 0 on each side of every document.
    n_docs = len(offs) - 1
    wide = np.zeros(len(codes) + 2 * n_docs, dtype=np.uint32)
    shift = np.repeat(2 * np.arange(n_docs) + 1, np.diff(limits))
    wide[np.arange(len(codes)) + shift] = codes
    limits = limits + 2 * np.arange(n_docs + 1)
    keep = np.ones(len(wide), dtype=bool)
    keep[1:] = (wide[1:] != 0) | (wide[:-1] != 0)
    keep[limits[:-1]] = True
    kept = np.zeros(len(wide) + 1, dtype=np.int64)
    np.cumsum(keep, out=kept[1:])
    return wide[keep], kept[limits]


def _ngrams(c: np.ndarray) -> np.ndarray:
    """Keys of all one- to three-letter n-grams of a letter array."""
    c = c.astype(_U)
    one = c[c != 0]
    two, three = (c[:-1] << _U(21)) | c[1:], (c[:-2] << _U(42)) | (c[1:-1] << _U(21)) | c[2:]
    two = two[(c[:-1] != 0) | (c[1:] != 0)]
    three = three[c[1:-1] != 0]
    top = _U(1 << 63)
    # Three letters use 63 bits; the top bit marks the shorter ones.
    return np.concatenate([(one << _U(42)) | top, two | top, three])


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, dtype=np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def _add(a, b):
    keys = np.concatenate([a[0], b[0]])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], np.concatenate([a[1], b[1]])[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, lang) to n-gram counts per language, summed within the task."""
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def flush():
        for lang, (keys, counts) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)),
                                              pa.array(counts.astype(np.int64))], schema=_COUNTS)
        sums.clear()

    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), dtype=object)
        for rows, data, offs in byte_blocks(batch.column(0), _BLOCK):
            codes, limits = _letter_runs(data, offs)
            # Documents begin and end with a blank, so they can be strung together.
            doc = np.repeat(np.arange(len(offs) - 1), np.diff(limits))
            own = langs[rows]
            for lang in dict.fromkeys(own):
                mine = codes[(own == lang)[doc]]
                got = _counted(_ngrams(mine)) if len(mine) > 2 else None
                if got is not None and len(got[0]):
                    sums[lang] = _add(sums[lang], got) if lang in sums else got
        if sum(len(k) for k, _ in sums.values()) > _FLUSH:
            yield from flush()
    yield from flush()


@dataclass
class Profiles:
    """Ranks of the n-grams of each language: ``ranks[i, j]`` is the rank of
    ``grams[i]`` in ``langs[j]``, or ``size`` where it is absent."""

    langs: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    size: int

    def nearest(self, grams: np.ndarray) -> tuple[str, float]:
        """Language and similarity (0 to 1) of a document's ranked n-grams."""
        if not len(grams) or not self.langs:
            return UNDETERMINED, 0.0
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        ranks = np.where((self.grams[at] == grams)[:, None], self.ranks[at], self.size)
        own = np.arange(len(grams))[:, None]
        out_of_place = np.where(ranks == self.size, self.size, np.abs(ranks - own)).sum(axis=0)
        best = int(np.argmin(out_of_place))
        return self.langs[best], float(1.0 - out_of_place[best] / (self.size * len(grams)))


def learn_profiles(df: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE_SIZE) -> Profiles:
    """Profiles of all languages of the given rows (those with a null language or
    text teach nothing). What reaches the driver is ``size`` n-grams a language."""
    rows = df.select(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l")).where("l is not null and t is not null")
    counts = rows.mapInArrow(lean(_count_batches), "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = [F.desc("n"), F.col("gram").bitwiseXOR(F.lit(-(1 << 63)))]  # ties by the unsigned key, as in documents
    by_slice = W.partitionBy("lang", F.pmod(F.hash("gram"), F.lit(_SLICES))).orderBy(*order)
    by_lang = W.partitionBy("lang").orderBy(*order)
    top = (counts.withColumn("r", F.row_number().over(by_slice)).where(F.col("r") <= size)
           .withColumn("r", F.row_number().over(by_lang)).where(F.col("r") <= size))
    got = top.select("lang", "gram", "r").toPandas()
    langs = sorted(got["lang"].unique())
    grams = np.unique(got["gram"].to_numpy().astype(np.int64).view(_U))
    ranks = np.full((len(grams), len(langs)), size, dtype=np.int32)
    place = {lang: j for j, lang in enumerate(langs)}
    ranks[np.searchsorted(grams, got["gram"].to_numpy().astype(np.int64).view(_U)), got["lang"].map(place).to_numpy(dtype=np.int64)] = got["r"].to_numpy() - 1
    return Profiles(langs, grams, ranks, size)


def document_profile(letters: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, ties by key."""
    keys, counts = _counted(_ngrams(letters))
    return keys[np.argsort(-counts, kind="stable")[:size]]


def _predict_batches(profiles: Profiles, text_col: str, lang_out: str, score_out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for _, data, offs in byte_blocks(batch.column(text_col), _BLOCK):
                codes, limits = _letter_runs(data, offs)
                for lo, hi in zip(limits[:-1], limits[1:]):
                    letters = codes[lo:hi]
                    lang, score = profiles.nearest(document_profile(letters, profiles.size)) if letters.any() else (UNDETERMINED, 0.0)
                    langs.append(lang)
                    scores.append(score)
            yield with_arrays(batch, **{lang_out: pa.array(langs, pa.string()), score_out: pa.array(scores, pa.float64())})
    return run


def identify(df: DataFrame, profiles: Profiles, text_col: str = "text", lang_out: str = "lang_pred",
             score_out: str = "score") -> DataFrame:
    """All columns of ``df`` with the predicted language and its similarity."""
    schema = extended(df, **{lang_out: T.StringType(), score_out: T.DoubleType()})
    return df.mapInArrow(lean(_predict_batches(profiles, text_col, lang_out, score_out)), schema)


