"""Fill-in-middle transformation over boundary sets (operator 12).

A text is cut into units (a run of the letters A-Z a-z, or any other single code
point). The byte positions at which units begin, and the end of the text, form a
``BoundarySet``; two seeded hashes of the id name the numbers of units before the two
cuts, and selecting those ranks in the set returns both cut positions. The unit
limits of a block of texts are found in one numpy pass over its UTF-8 bytes; texts
never meet, so there is no shuffle.

Forms: ``plain`` (the text as it is: empty texts, texts that hold a mark, and the
share of documents that the hash leaves out), ``psm`` (prefix, suffix, middle) and
``spm`` (suffix, prefix, middle), each part behind its mark. No part holds a mark and
a mark cannot begin in the end of a part, so the first mark of each kind is the real
one and ``restored`` returns the exact text.

Null texts count as empty, and a null id hashes as an empty one. Equal ids get equal
hashes, so repeated rows come out alike. All rows and columns are kept, except that
columns named like the new ones are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.boundary_set import BoundarySet
from kestrel.llm.common import extended, with_arrays
from kestrel.llm.textblocks import byte_blocks

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PERCENT = 90      # of documents that are transformed
SPM_PERCENT = 20  # of those, suffix first
SEED = 1

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("A"): ord("Z") + 1] = True
_LETTER[ord("a"): ord("z") + 1] = True

_NEW = {"n_units": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(),
        "output": T.StringType()}


def draws(id_col: str, seed: int) -> Column:
    """Four seeded 32-bit numbers of the id, as an array."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)])


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the bytes of several texts: where units begin, and the number of code points
    that begin before each byte (one more at the end)."""
    point = (data & 0xC0) != 0x80
    letter = _LETTER[data]
    goes_on = np.zeros(len(data), dtype=bool)
    goes_on[1:] = letter[1:] & letter[:-1]
    first = offsets[:-1]
    goes_on[first[first < len(data)]] = False
    points = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(point, out=points[1:])
    return np.flatnonzero(point & ~goes_on), points


def transformed(text: bytes, starts: np.ndarray, h: tuple[int, int, int, int], percent: int, spm_percent: int):
    """(units, form, cut, cut, output) of one text whose units begin at ``starts``."""
    n = len(starts)
    if n == 0 or h[2] % 100 >= percent or any(m.encode() in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    cuts = BoundarySet(np.append(starts, len(text)))
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = cuts.select(a), cuts.select(b)
    prefix, middle, suffix = PREFIX.encode() + text[:a], MIDDLE.encode() + text[a:b], SUFFIX.encode() + text[b:]
    if h[3] % 100 < spm_percent:
        return n, "spm", a, b, suffix + prefix + middle
    return n, "psm", a, b, prefix + suffix + middle


def _batches(text_col: str, draw_col: str, percent: int, spm_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(draw_col).flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
            for rows, data, offs in byte_blocks(batch.column(text_col)):
                starts, points = unit_starts(data, offs)
                first = np.searchsorted(starts, offs)
                raw = data.tobytes()
                out = []
                for k in range(len(offs) - 1):
                    lo, hi = int(offs[k]), int(offs[k + 1])
                    own = starts[first[k]: first[k + 1]] - lo
                    n, form, a, b, output = transformed(raw[lo:hi], own, tuple(numbers[rows.start + k].tolist()), percent, spm_percent)
                    chars = (None, None) if a is None else (int(points[lo + a] - points[lo]), int(points[lo + b] - points[lo + a]))
                    out.append((n, form, *chars, output))
                part = batch.slice(rows.start, rows.stop - rows.start).drop_columns([draw_col])
                units, forms, prefixes, middles, outputs = zip(*out)
                yield with_arrays(part, n_units=pa.array(units, pa.int64()), form=pa.array(forms, pa.string()),
                                  prefix_chars=pa.array(prefixes, pa.int64()), middle_chars=pa.array(middles, pa.int64()),
                                  output=pa.array(outputs, pa.binary()).cast(pa.string()))
    return run


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                   spm_percent: int = SPM_PERCENT, seed: int = SEED) -> DataFrame:
    """The rows with n_units, form, prefix_chars, middle_chars (code points; null if
    plain) and output."""
    draw_col = "_draws"
    while draw_col in df.columns:
        draw_col += "_"
    schema = extended(df, **_NEW)
    return df.withColumn(draw_col, draws(id_col, seed)).mapInArrow(_batches(text_col, draw_col, percent, spm_percent), schema)


def restored(output: Column, form: Column) -> Column:
    """The text that was transformed."""
    skip = len(PREFIX)

    def between(first: str, second: str) -> Column:
        at = F.position(F.lit(second), output)
        middle = F.position(F.lit(MIDDLE), output, at)
        head = F.substr(output, F.lit(skip + 1), at - skip - 1)
        tail = F.substr(output, at + skip, middle - at - skip)
        parts = {first: head, second: tail, MIDDLE: F.substr(output, middle + skip)}
        return F.concat(parts[PREFIX], parts[MIDDLE], parts[SUFFIX])

    return F.when(form == "psm", between(PREFIX, SUFFIX)).when(form == "spm", between(SUFFIX, PREFIX)).otherwise(output)
