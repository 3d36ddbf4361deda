"""Exact order statistics of many columns and groups at once.

A double's bits, with the sign folded in, are whole numbers in the order of the
values. A pass counts, for every open rank, the next ``DIGIT_BITS`` bits of the values
that share the bits found so far, and the running sum of the counts names the next
bits of the rank. After ``64 / DIGIT_BITS`` passes every rank of every column and
group is known exactly, whatever the values. The number of passes depends on neither
the columns nor the groups nor the ranks.

A task adds its counts up in numpy and hands on at most 2^DIGIT_BITS rows per column,
group and open prefix; one row per open rank reaches the driver. Nulls and NaN are no
values; -0.0 counts as 0.0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIGIT_BITS = 16
_U = np.uint64
_TOP = _U(1 << 63)
_OUT = "spec int, digit int, n bigint"


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """uint64 in the order of the doubles."""
    bits = (x + 0.0).view(_U)
    return np.where(bits & _TOP, ~bits, bits | _TOP)


def from_bits(u: int) -> float:
    bits = u ^ (1 << 63) if u >> 63 else u ^ ((1 << 64) - 1)
    return float(np.array([bits], dtype=_U).view(np.float64)[0])


def _digit_batches(columns: list[str], open_: list[list[tuple]], known: int):
    """``open_``: per column its open (group, prefix, spec), where ``known`` bits of the
    prefix are found. Counts of the next digit per spec."""
    tables = []
    for specs in open_:
        groups: dict = {}
        for g, prefix, spec in specs:
            groups.setdefault(g, []).append((prefix, spec))
        tables.append({g: (np.array([p for p, _ in sorted(s)], dtype=_U), np.array([i for _, i in sorted(s)])) for g, s in groups.items()})
    last = _U(64 - known - DIGIT_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            group = batch.column("__g").to_numpy(zero_copy_only=False)
            for c, table in zip(columns, tables):
                column = batch.column(c)
                x = column.fill_null(float("nan")).to_numpy(zero_copy_only=False)
                there = ~np.isnan(x)
                for g, (prefixes, specs) in table.items():
                    u = ordered_bits(x[there & (group == g)])
                    head = u >> _U(64 - known) if known else np.zeros(len(u), dtype=_U)
                    at = np.minimum(np.searchsorted(prefixes, head), len(prefixes) - 1)
                    hit = prefixes[at] == head
                    digit = ((u[hit] >> last) & _U((1 << DIGIT_BITS) - 1)).astype(np.int64)
                    for k in np.unique(at[hit]):
                        count = np.bincount(digit[at[hit] == k], minlength=1 << DIGIT_BITS)
                        spec = int(specs[k])
                        sums[spec] = sums[spec] + count if spec in sums else count
        for spec, count in sums.items():
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), spec, dtype=np.int32)), pa.array(some.astype(np.int32)), pa.array(count[some])], names=["spec", "digit", "n"])
    return run


def select_ranks(df: DataFrame, columns: list[str], wanted: dict[tuple[str, object], list[int]], group_col: str | None = None) -> dict:
    """The values at 0-based ranks: ``wanted`` maps (column, group) to ranks, which must
    lie below the number of values there; the result maps (column, group, rank) to the
    value. Without ``group_col`` the group is None."""
    keys = list(dict.fromkeys(g for _, g in wanted))
    number = F.lit(0)
    if group_col is not None:
        number = F.lit(-1)
        for i, g in enumerate(keys):
            number = F.when(F.col(group_col).eqNullSafe(F.lit(g)), F.lit(i)).otherwise(number)
    rows = df.select(number.cast("int").alias("__g"), *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    # A state per rank: bits found, and the rank among the values that share them.
    state = {(c, g, r): (0, r) for (c, g), ranks in wanted.items() for r in ranks}
    for known in range(0, 64, DIGIT_BITS):
        specs = list(dict.fromkeys((c, g, bits) for (c, g, _), (bits, _) in state.items()))
        at = {s: i for i, s in enumerate(specs)}
        open_ = [[(keys.index(g), bits, at[c, g, bits]) for c2, g, bits in specs if c2 == c] for c in columns]
        counts = rows.mapInArrow(_digit_batches(columns, open_, known), _OUT).groupBy("spec", "digit").agg(F.sum("n").alias("n"))
        before = F.coalesce(F.sum("n").over(Window.partitionBy("spec").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        asked = F.explode(F.from_json(F.lit("[" + ",".join(f'{{"spec":{at[c, g, bits]},"rank":{r}}}' for (c, g, _), (bits, r) in state.items()) + "]"),
                                      "array<struct<spec:int,rank:bigint>>")).alias("x")
        ranks = df.sparkSession.range(1).select(asked).select("x.*").distinct()
        found = (counts.withColumn("before", before).join(F.broadcast(ranks), "spec")   # one row per open rank
                 .where("before <= rank and rank < before + n").select("spec", "rank", "digit", "before").collect())
        step = {(r["spec"], r["rank"]): (r["digit"], r["rank"] - r["before"]) for r in found}
        for key, (bits, r) in state.items():
            digit, rest = step[at[key[0], key[1], bits], r]
            state[key] = (bits << DIGIT_BITS | digit, rest)
    return {key: from_bits(bits) for key, (bits, _) in state.items()}


def interpolated(df: DataFrame, columns: list[str], counts: dict[tuple[str, object], int], probs, group_col: str | None = None) -> dict:
    """Linearly interpolated quantiles of (column, group) with these numbers of values."""
    places = {key: [p * (n - 1) for p in probs] for key, n in counts.items() if n}
    wanted = {key: sorted({k for x in xs for k in (math.floor(x), math.ceil(x))}) for key, xs in places.items()}
    values = select_ranks(df, columns, wanted, group_col) if wanted else {}

    def at(key, x):
        low, high = values[(*key, math.floor(x))], values[(*key, math.ceil(x))]
        return low if low == high else low + (high - low) * (x - math.floor(x))

    return {key: [at(key, x) for x in places[key]] if n else [None] * len(probs) for key, n in counts.items()}
