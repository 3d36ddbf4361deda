"""Scalar statistics that stay exact at any size, and ordered running sums.

Spark's exact ``percentile`` merges every distinct value of a group in one
task, and a window without ``partitionBy`` runs in one task. Both are fine for
bounded inputs and wrong for unbounded ones, so each helper here measures its
input first and switches to a distributed method past ``small`` rows:

* quantiles: bracket the wanted rank with ``percentile_approx`` (rank error at
  most m/accuracy), count the rows below, at, between and above the two bracket
  values, and repeat in the open part that holds the rank. The bracket values
  themselves leave with each pass, so it ends however heavy they are; a pass
  usually shrinks the candidates by about ``accuracy/6``. Exact at the end.
* running sums: cut the ordered key into ranges with ``percentile_approx``,
  sum per range, prefix-sum the (few) range totals, then run the window per
  range in parallel.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.selection import interpolated

SMALL = 2_000_000        # rows one task may sort or hold as a percentile state
ACCURACY = 10_000        # percentile_approx accuracy used to bracket ranks


def _clean(df: DataFrame, col) -> DataFrame:
    x = (F.col(col) if isinstance(col, str) else col).cast("double")
    return df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))


def _interpolate(vals: dict, n: int, p: float) -> float:
    pos = p * (n - 1)
    lo, hi = math.floor(pos), math.ceil(pos)
    a, b = vals[lo], vals[hi]
    return a + (b - a) * (pos - lo)


def disc_expr(col: str, rank: int, n: int) -> Column:
    """Exact value at 0-based ``rank`` among ``n`` non-null values of ``col``:
    ``percentile_disc`` at (rank + 1/2) / n, which is half a rank away from
    both neighbours, so float rounding cannot move it. One aggregate pass
    holding the distinct values of a bounded set."""
    p = (rank + 0.5) / n
    return F.expr(f"percentile_disc({p!r}) WITHIN GROUP (ORDER BY `{col}`)")


DIRECT_MAX = 100_000      # values one exact percentile pass may sort quickly


def order_stats(df: DataFrame, specs, direct: int = DIRECT_MAX, small: int = SMALL,
                accuracy: int = ACCURACY) -> list:
    """Exact order statistics, several at once.

    ``specs``: list of ``(x, cond, rank, n)``: the value at 0-based ``rank``
    among the ``n`` non-null values of Column ``x`` on rows where ``cond``
    (a Column or None) holds. NaN counts as null. Each round is one pass for
    all open ranks: while a rank's candidate set is larger than ``direct`` it is
    bracketed with ``percentile_approx`` and cut at the bracket by exact counts
    (a second pass); once at most ``direct`` candidates remain, one
    ``percentile_disc`` pass over them gives the exact value.
    """
    cols = []
    for i, (x, cond, _, _) in enumerate(specs):
        v = (F.col(x) if isinstance(x, str) else x).cast("double")
        v = F.when(~F.isnan(v), v)
        cols.append((v if cond is None else F.when(cond, v)).alias(f"v{i}"))
    base = df.select(*cols)
    st = [{"lo": None, "hi": None, "below": 0, "m": n, "r": r, "done": n == 0, "val": None}
          for (_, _, r, n) in specs]
    # Several passes follow when a rank needs bracketing: keep just the value
    # columns (one double per spec) in memory / disk for the duration of this
    # call instead of recomputing the input's lineage each pass.
    cached = any(s["m"] > direct for s in st)
    if cached:
        base = base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _order_stats_loop(base, st, direct, accuracy)
    finally:
        if cached:
            base.unpersist()


def _order_stats_loop(base: DataFrame, st: list, direct: int, accuracy: int) -> list:
    """Each open rank holds an open interval (lo, hi) of candidate values, the
    number of its rows ``m`` and of the rows ``below`` it. A pass takes two of
    the candidate values as pivots and counts the rows below, at, between and
    above them; the rank is at a pivot (done) or in one of the three open
    parts, none of which holds the pivots' rows. So every pass shrinks every
    open interval, whatever the approximate quantiles returned and however
    heavy single values are.
    """
    def value(i):
        return F.col(f"v{i}")

    def inside(i):
        c = value(i).isNotNull()
        if st[i]["lo"] is not None:
            c = c & (value(i) > F.lit(st[i]["lo"]))
        if st[i]["hi"] is not None:
            c = c & (value(i) < F.lit(st[i]["hi"]))
        return c

    while not all(s["done"] for s in st):
        ready = [i for i, s in enumerate(st) if not s["done"] and s["m"] <= direct]
        if ready:
            sel = base.select(*[F.when(inside(i), value(i)).alias(f"__w{i}") for i in ready])
            row = sel.agg(*[disc_expr(f"__w{i}", st[i]["r"] - st[i]["below"], st[i]["m"]).alias(f"d{i}")
                            for i in ready]).first()
            for i in ready:
                st[i]["val"], st[i]["done"] = row[f"d{i}"], True
            continue
        act = [i for i, s in enumerate(st) if not s["done"]]
        margin, qs = 3.0 / accuracy, {}
        for i in act:
            m, r = st[i]["m"], st[i]["r"] - st[i]["below"]
            qs[i] = [max(0.0, r / m - margin), min(1.0, (r + 1) / m + margin)]
        row = base.agg(*[F.percentile_approx(F.when(inside(i), value(i)), qs[i], accuracy)
                         .alias(f"q{i}") for i in act]).first()
        ab = {i: row[f"q{i}"] for i in act}
        row = base.agg(*[c for i in act for c in (
            F.count_if(inside(i) & (value(i) < F.lit(ab[i][0]))).alias(f"lt{i}"),
            F.count_if(inside(i) & (value(i) == F.lit(ab[i][0]))).alias(f"at_a{i}"),
            F.count_if(inside(i) & (value(i) > F.lit(ab[i][0])) & (value(i) < F.lit(ab[i][1]))).alias(f"mid{i}"),
            F.count_if(inside(i) & (value(i) == F.lit(ab[i][1]))).alias(f"at_b{i}"))]).first()
        for i in act:
            s, (a, b) = st[i], ab[i]
            before, r = s["m"], s["r"] - s["below"]
            # The parts in order: below a, a itself, between, b itself, above b.
            parts = [(row[f"lt{i}"], s["lo"], a), (row[f"at_a{i}"], a, None)]
            if a < b:
                parts += [(row[f"mid{i}"], a, b), (row[f"at_b{i}"], b, None)]
            parts.append((s["m"] - sum(p[0] for p in parts), b, s["hi"]))
            for k, (rows, lo, hi) in enumerate(parts):
                if r < rows:
                    if k % 2:
                        s["val"], s["done"] = lo, True
                    else:
                        s["lo"], s["hi"], s["m"] = lo, hi, rows
                    break
                r -= rows
                s["below"] += rows
            if not s["done"] and s["m"] >= before:
                raise RuntimeError("an order statistic's candidates did not shrink: the input changes between passes")
    return [s["val"] for s in st]


def kth_smallest(x: DataFrame, rank: int, n: int, small: int = SMALL,
                 accuracy: int = ACCURACY, direct: int = DIRECT_MAX):
    """Value at 0-based ``rank`` of column ``x`` (non-null doubles, ``n`` rows)."""
    return order_stats(x, [("x", None, rank, n)], min(direct, small), small, accuracy)[0]


def exact_quantiles(df: DataFrame, col, probs, small: int = SMALL,
                    n_upper: int | None = None) -> list:
    """Linearly interpolated quantiles (pandas / numpy default) of one column.

    ``n_upper``: a known upper bound on the number of rows (e.g. the table's
    row count); when it is within ``small`` the count pass is skipped and one
    exact ``percentile`` aggregate answers directly.
    """
    x = _clean(df, col)
    direct = min(DIRECT_MAX, small)
    if n_upper is not None and n_upper <= direct:
        row = x.agg(*[F.percentile("x", float(p)).alias(f"q{i}")
                      for i, p in enumerate(probs)]).first()
        return [row[f"q{i}"] for i in range(len(probs))]
    n = x.count()
    if n == 0:
        return [None] * len(probs)
    if n <= direct:
        row = x.agg(*[F.percentile("x", float(p)).alias(f"q{i}")
                      for i, p in enumerate(probs)]).first()
        return [row[f"q{i}"] for i in range(len(probs))]
    ranks = sorted({r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))})
    vals = dict(zip(ranks, order_stats(x, [("x", None, r, n) for r in ranks], direct, small)))
    return [_interpolate(vals, n, p) for p in probs]


def exact_median(df: DataFrame, col, small: int = SMALL, n_upper: int | None = None):
    return exact_quantiles(df, col, [0.5], small, n_upper)[0]


def column_quantiles(df: DataFrame, cols, probs, small: int = SMALL,
                     n_upper: int | None = None) -> dict:
    """Quantiles of several columns; bounded columns share one aggregate pass
    (no count pass when ``n_upper``, a bound on the row count, is small)."""
    small = min(small, DIRECT_MAX)
    if n_upper is not None and n_upper <= small:
        counts = {c: n_upper for c in cols}
    else:
        counts = df.agg(*[F.count(F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`"))).alias(c)
                          for c in cols]).first().asDict()
    out = {}
    bounded = [c for c in cols if counts[c] <= small]
    if bounded:
        row = df.agg(*[F.percentile(F.when(~F.isnan(F.col(c).cast("double")),
                                           F.col(c).cast("double")), float(p)).alias(f"{c}__{i}")
                       for c in bounded for i, p in enumerate(probs)]).first()
        for c in bounded:
            out[c] = [row[f"{c}__{i}"] for i in range(len(probs))]
    many = [c for c in cols if c not in out]
    if many:
        # All of them together, in a fixed number of passes.
        found = interpolated(df, many, {(c, None): counts[c] for c in many}, probs)
        out.update({c: found[c, None] for c in many})
    return out


def grouped_quantiles(df: DataFrame, group_col: str, col: str, probs,
                      small: int = SMALL) -> dict:
    """Quantiles per group for a low-cardinality group column (e.g. a label)."""
    valued = F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double"))
    sizes = {r[0]: r[1] for r in df.where(valued).groupBy(group_col).count().collect()}
    if sizes and max(sizes.values()) <= min(small, DIRECT_MAX):
        rows = (df.where(valued).groupBy(group_col)
                .agg(*[F.percentile(F.col(col).cast("double"), float(p)).alias(f"q{i}")
                       for i, p in enumerate(probs)]).collect())
        return {r[0]: [r[f"q{i}"] for i in range(len(probs))] for r in rows}
    found = interpolated(df, [col], {(col, g): n for g, n in sizes.items()}, probs, group_col)
    return {g: found[col, g] for g in sizes}


def adjusted_skew(c) -> Column:
    """pandas ``Series.skew()``: the bias-adjusted sample skewness G1.

    Spark's ``skewness`` is the population g1; G1 = g1 * sqrt(n(n-1)) / (n-2).
    NULL for fewer than three values; NULL (not 0) for a constant column.
    """
    c = F.col(c) if isinstance(c, str) else c
    n = F.count(c).cast("double")
    return F.when(n >= 3, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def running_sums(df: DataFrame, key: str, cols, descending: bool = False,
                 small: int = SMALL, suffix: str = "_cum") -> DataFrame:
    """Inclusive running sums of ``cols`` in the order of a numeric ``key``.

    ``df`` must hold one row per key value (aggregate first). Adds a column
    ``<c><suffix>`` per summed column. Rows whose key is null or NaN have no
    place in the order and are left out, whatever the size.
    """
    df = df.where(F.col(key).isNotNull() & ~F.isnan(F.col(key).cast("double")))
    order = F.desc(key) if descending else F.asc(key)
    n = df.count()
    if n <= small:
        w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(c).over(w).alias(c + suffix) for c in cols])
    # Range-cut the key into about 2n/small slices of bounded size.
    k = F.col(key).cast("double")
    sk = (-k if descending else k)
    parts = max(2, math.ceil(2 * n / small))
    qs = [i / parts for i in range(1, parts)]
    cuts = df.agg(F.percentile_approx(sk, qs, ACCURACY).alias("c")).first()["c"]
    splits = [-math.inf] + sorted(set(float(v) for v in cuts)) + [math.inf]
    keyed = df.withColumn("__sk", sk)
    sliced = Bucketizer(splits=splits, inputCol="__sk", outputCol="__slice").transform(keyed)
    totals = sliced.groupBy("__slice").agg(*[F.sum(c).alias(c + "__t") for c in cols])
    wt = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    # At most len(splits) rows: the single-partition window is bounded.
    offsets = totals.select("__slice", *[F.coalesce(F.sum(c + "__t").over(wt), F.lit(0))
                                         .alias(c + "__o") for c in cols])
    w = (Window.partitionBy("__slice").orderBy("__sk")
         .rowsBetween(Window.unboundedPreceding, 0))
    out = (sliced.join(F.broadcast(offsets), "__slice")
           .select(*df.columns, *[(F.sum(c).over(w) + F.col(c + "__o")).alias(c + suffix)
                                  for c in cols]))
    return out
