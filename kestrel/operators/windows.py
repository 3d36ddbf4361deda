"""Skew-safe trailing (range) windows per entity.

A plain ``Window.partitionBy(entity).orderBy(t).rangeBetween(-width, 0)``
sends all rows of one entity to one task. Here rows are grouped by
(entity, slice) with slice = floor(t / width); every row is also copied, as
read-only context, into the next ``context`` slices. A row's frame
[t - width, t] lies in its own slice and the previous one, so each
(entity, slice) group has every row it needs, and a hot entity is spread over
as many groups as its history has slices. Context copies are dropped after
the window is evaluated. Rows with a NULL time are not copied. A NULL entity
names nobody: each such row is a group of its own and sees only itself.

An entity with more rows in one slice than a task should hold (``hot_accounts``)
is cut further, into chunks of bounded rows (``chunked_measures``,
``previous_row``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.numbering import CHUNK_ROWS, range_chunks
from kestrel.session import cut_lineage


def trailing_range_aggregate(df: DataFrame, id_col: str, t_col: str, width: int,
                             key_col: str | None, aggs: dict[str, Callable],
                             context: int = 1, pre: dict[str, Callable] | None = None
                             ) -> DataFrame:
    """Evaluate window expressions over each row's trailing ``width`` frame.

    ``aggs`` maps output names to ``fn(w) -> Column`` where ``w`` is the range
    window [t - width, t]. ``pre`` (optional) maps names to ``fn(wr)`` with
    ``wr`` a row-ordered window (t, key_col) over the same group; they are
    evaluated first (e.g. ``lag``) and may be used by ``aggs``. When ``pre``
    looks back one row, use ``context=2`` so context rows have their own
    predecessor.
    """
    t = F.col(t_col)
    alone = F.col(id_col).isNull()
    shift = F.explode(F.when(t.isNull() | alone, F.array(F.lit(0)))
                      .otherwise(F.sequence(F.lit(0), F.lit(context))))
    expanded = (df.withColumn("__alone", F.when(alone, F.monotonically_increasing_id()))
                .select("*", shift.alias("__shift"))
                .withColumn("__slice", F.floor(t / F.lit(width)) + F.col("__shift")))
    part = [id_col, "__slice", "__alone"]
    order = [t_col] + ([key_col] if key_col else [])
    if pre:
        wr = Window.partitionBy(*part).orderBy(*order)
        expanded = expanded.select("*", *[fn(wr).alias(n) for n, fn in pre.items()])
    w = Window.partitionBy(*part).orderBy(t).rangeBetween(-width, 0)
    out = expanded.select("*", *[fn(w).alias(n) for n, fn in aggs.items()])
    return out.where(F.col("__shift") == 0).drop("__shift", "__slice", "__alone", *(pre or {}).keys())


# Hot accounts -----------------------------------------------------------------
MOST_HOT = 10_000     # accounts that can hold more than one in MOST_HOT rows in a slice

# How partial results of a measure add up.
_ADD = {"sum": F.sum, "min": F.min}


def hot_accounts(df: DataFrame, id_col: str, t_col: str, width: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame | None:
    """The accounts that have more rows in one slice of ``width`` than a task should
    hold; None if there are none. There are at most ``MOST_HOT``, so their ids can be
    broadcast whatever the size of the table."""
    known = df.where(F.col(id_col).isNotNull() & F.col(t_col).isNotNull())
    slices = cut_lineage(known.groupBy(F.col(id_col).alias("__hot"), F.floor(F.col(t_col) / F.lit(width)).alias("s")).count())
    total = slices.agg(F.sum("count").alias("n")).first()["n"] or 0
    hot = slices.where(F.col("count") > max(chunk_rows, total // MOST_HOT)).select("__hot").distinct()
    return None if hot.isEmpty() else hot


def trailing_measures(df: DataFrame, id_col: str, t_col: str, width: int, key_col: str | None,
                      measures: dict[str, tuple[str, str | None]], strict: bool = False,
                      chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``measures`` (name -> (count | sum | avg | min, column)) over each row's
    [t - width, t], or [t - width, t) if ``strict``. Sums and averages of nothing are
    0, a minimum of nothing is null.

    Accounts with bounded slices go through ``trailing_range_aggregate``, hot ones
    through ``chunked_measures``."""
    hot = hot_accounts(df, id_col, t_col, width, chunk_rows)
    end = -1 if strict else 0

    def over(kind, c):
        def fn(w):
            w = w.rangeBetween(-width, end)
            if kind == "count":
                return F.count(F.lit(1)).over(w)
            x = getattr(F, kind)(c).over(w)
            return x if kind == "min" else F.coalesce(x, F.lit(0).cast("double" if kind == "avg" else _sum_type(df, c)))
        return fn

    aggs = {name: over(kind, c) for name, (kind, c) in measures.items()}
    plain = lambda rows: trailing_range_aggregate(rows, id_col, t_col, width, key_col, aggs)
    if hot is None:
        return plain(df)
    cold, busy = split_by(df, id_col, t_col, hot)
    return plain(cold).unionByName(chunked_measures(busy, id_col, t_col, width, measures, strict, chunk_rows))


def split_by(df: DataFrame, id_col: str, t_col: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the other accounts (and all rows without a time), and of the hot ones."""
    timed = F.col(t_col).isNotNull()
    busy = df.where(timed).join(F.broadcast(hot), F.col(id_col) == F.col("__hot"), "left_semi")
    cold = df.where(timed).join(F.broadcast(hot), F.col(id_col) == F.col("__hot"), "left_anti")
    return cold.unionByName(df.where(~timed)), busy


def _sum_type(df: DataFrame, c: str) -> str:
    return "bigint" if df.schema[c].dataType.typeName() in ("byte", "short", "integer", "long") else "double"


def _as_of(rows: DataFrame, at: str, marks: DataFrame, group: list[str], out: str) -> DataFrame:
    """For each row the smallest mark (group, mark, ``out``) at or after ``at``: one
    sort per group, the marks before the rows of the same time, running backwards."""
    names = rows.columns
    every = rows.withColumns({"__at": F.col(at), "__mark": F.lit(1), out: F.lit(None).cast("long")}).unionByName(
        marks.select(*group, F.col("mark").alias("__at"), F.lit(0).alias("__mark"), out), allowMissingColumns=True)
    back = Window.partitionBy(*group).orderBy(F.col("__at").desc(), "__mark").rowsBetween(Window.unboundedPreceding, 0)
    return every.withColumn(out, F.last(out, ignorenulls=True).over(back)).where("__mark = 1").select(*names, out)


def chunked_measures(df: DataFrame, id_col: str, t_col: str, width: int, measures: dict[str, tuple[str, str | None]],
                     strict: bool = False, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``trailing_measures`` for accounts whose slices no single task should hold.

    Equal times of an account are summed first. Its times are then cut into chunks of
    ``chunk_rows``, and a frame that begins in chunk B and ends in chunk A is the sum of
    three parts: the times of A inside it (a window in A), the whole chunks between
    (totals of blocks of 2^k chunks, at most two a level), and the end of B. For the
    last part the times of A whose frames begin in B meet the times of B; as chunks do
    not overlap there are no more such pairs of chunks than twice the chunks, so a
    group has at most two chunks of rows and all groups together a few times the input.
    No part is subtracted from another, so nothing is lost to rounding.
    """
    parts = {}   # partial column -> (how it adds up, row-level value)
    for name, (kind, c) in measures.items():
        if kind in ("count", "avg"):
            parts[f"__n_{name}"] = ("sum", F.lit(1).cast("long") if kind == "count" else F.col(c).isNotNull().cast("long"))
        if kind in ("sum", "avg"):
            parts[f"__s_{name}"] = ("sum", F.col(c))
        if kind == "min":
            parts[f"__m_{name}"] = ("min", F.col(c))
    merge = [_ADD[how](p).alias(p) for p, (how, _) in parts.items()]
    key, group = F.col(id_col).alias("__id"), ["__id", "__i"]
    times = (df.select(key, F.col(t_col).alias("__t"), *[x.alias(p) for p, (_, x) in parts.items()])
             .groupBy("__id", "__t").agg(*merge))
    placed = range_chunks(times, ["__id", "__t"], chunk_rows)
    segments = placed.groupBy("__id", "__chunk").agg(F.min("__t").alias("first"), F.max("__t").alias("last"), *merge)
    by_id = Window.partitionBy("__id").orderBy("__chunk")
    segments = cut_lineage(segments.withColumn("__i", (F.row_number().over(by_id) - 1).cast("long")))
    rows = placed.join(segments.select("__id", "__chunk", "__i"), ["__id", "__chunk"]).drop("__chunk").withColumn("lo", F.col("__t") - width)
    # The chunks in which the frames of a chunk can begin.
    ends = segments.select("__id", F.col("last").alias("mark"), F.col("__i").alias("b"))
    edge = segments.select("__id", "__i", (F.col("first") - width).alias("from"), (F.col("last") - width).alias("to"))
    edge = _as_of(edge, "from", ends, ["__id"], "b").withColumnRenamed("b", "b0")
    edge = _as_of(edge, "to", ends, ["__id"], "b").withColumnRenamed("b", "b1")
    pairs = cut_lineage(edge.select("__id", "__i", F.explode(F.sequence("b0", "b1")).alias("b")))
    marks = pairs.join(ends, ["__id", "b"]).select("__id", "__i", "mark", "b")
    rows = cut_lineage(_as_of(rows, "lo", marks, group, "b"))

    # 1. Inside the own chunk.
    own = Window.partitionBy(*group).orderBy("__t").rangeBetween(-width, -1 if strict else 0)
    first = rows.select("__id", "__i", "__t", "b", *[_ADD[how](p).over(own).alias(p) for p, (how, _) in parts.items()])
    # 2. The end of the chunk in which the frame begins.
    asks = rows.where("b < __i").select("__id", "b", "__i", "__t", F.col("lo").alias("__at"), F.lit(1).alias("__ask"))
    told = (pairs.where("b < __i").join(rows.select("__id", F.col("__i").alias("b"), F.col("__t").alias("__at"), *parts), ["__id", "b"])
            .withColumn("__ask", F.lit(0)))
    back = Window.partitionBy("__id", "__i", "b").orderBy(F.col("__at").desc(), "__ask").rowsBetween(Window.unboundedPreceding, 0)
    second = (asks.unionByName(told, allowMissingColumns=True)
              .select("__id", "__i", "__t", "b", "__ask", *[_ADD[how](p).over(back).alias(p) for p, (how, _) in parts.items()])
              .where("__ask = 1").drop("__ask"))
    # 3. Whole chunks between, the same for all rows of a pair.
    levels = max(1, int(segments.agg(F.max("__i").alias("m")).first()["m"] or 0).bit_length())
    blocks = (segments.select("__id", "__i", *parts, F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("k"))
              .groupBy("__id", "k", F.expr("shiftright(__i, k)").alias("j")).agg(*merge))
    inner = pairs.where("b + 1 < __i").select("__id", "__i", "b", F.explode(dyadic_blocks(F.col("b") + 1, F.col("__i") - 1, levels)).alias("x"))
    between = (inner.select("__id", "__i", "b", "x.k", "x.j").join(blocks, ["__id", "k", "j"])
               .groupBy("__id", "__i", "b").agg(*merge))
    third = rows.select("__id", "__i", "__t", "b").join(between, ["__id", "__i", "b"])

    found = first.unionByName(second).unionByName(third).groupBy("__id", "__t").agg(*merge)
    answer = {}
    for name, (kind, c) in measures.items():
        n, s = F.col(f"__n_{name}"), F.col(f"__s_{name}")
        answer[name] = (F.coalesce(n, F.lit(0).cast("long")) if kind == "count" else F.col(f"__m_{name}") if kind == "min" else
                        F.coalesce(s, F.lit(0).cast(_sum_type(df, c))) if kind == "sum" else F.coalesce(F.try_divide(s, n), F.lit(0.0)))
    result = found.select(F.col("__id").alias("__acc"), F.col("__t").alias("__when"), *[x.alias(name) for name, x in answer.items()])
    return df.join(result, (F.col(id_col) == F.col("__acc")) & (F.col(t_col) == F.col("__when"))).select(*df.columns, *answer)


def dyadic_blocks(low, high, levels: int):
    """The blocks (k, j) of 2^k aligned numbers that together are low..high: at each
    level the first and the last full block that no larger block holds."""
    found = []
    for k in range(levels):
        # Shifts round down, also for the -1 of an empty level.
        a, b = F.shiftright(low + ((1 << k) - 1), k), F.shiftright(high + 1, k) - 1
        pa, pb = F.shiftright(low + ((2 << k) - 1), k + 1), F.shiftright(high + 1, k + 1) - 1
        alone = lambda j, pa=pa, pb=pb: (pa > pb) | (j < 2 * pa) | (j > 2 * pb + 1)
        found.append(F.when((a <= b) & alone(a), F.struct(F.lit(k).alias("k"), a.cast("long").alias("j"))))
        found.append(F.when((a < b) & alone(b), F.struct(F.lit(k).alias("k"), b.cast("long").alias("j"))))
    return F.array_compact(F.array(*found))


def previous_row(df: DataFrame, id_col: str, t_col: str, key_col: str | None, columns: dict[str, str],
                 chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``columns`` (name -> column) of the account's row before, in (t, key) order. The
    rows are cut into chunks in that order; the first row of a chunk takes the last of
    the account's chunk before."""
    order = [t_col] + ([key_col] if key_col else [])
    placed = range_chunks(df.withColumn("__same", F.monotonically_increasing_id()), [id_col, *order, "__same"], chunk_rows)
    at = Window.partitionBy(id_col, "__chunk").orderBy(*order, "__same")
    inside = placed.select("*", F.row_number().over(at).alias("__r"), *[F.lag(c).over(at).alias(n) for n, c in columns.items()])
    ends = placed.groupBy(id_col, "__chunk").agg(F.max(F.struct(*order, "__same", *[F.col(c).alias(f"v_{n}") for n, c in columns.items()])).alias("x"))
    before = ends.select(F.col(id_col).alias("__id"), F.col("__chunk").alias("__c"), F.lag("x").over(Window.partitionBy(id_col).orderBy("__chunk")).alias("x"))
    joined = inside.join(before, (F.col(id_col) == F.col("__id")) & (F.col("__chunk") == F.col("__c")) & (F.col("__r") == 1), "left")
    return joined.select(*df.columns, *[F.when(F.col("__r") == 1, F.col(f"x.v_{n}")).otherwise(F.col(n)).alias(n) for n in columns])
