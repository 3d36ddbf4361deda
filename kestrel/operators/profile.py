"""Data profiling (G1-G12): the tables behind the exploratory charts.

Every table is an aggregate; wide per-column statistics are computed in one
``agg`` and unpivoted with ``stack``. Quantiles use the exact helpers in
``kestrel.functions.stats``; ranks (Kruskal-Wallis) use distributed running
sums over distinct values, never a global sort of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel import schemas as SC
from kestrel.functions.casts import nan_to_null
from kestrel.functions.stats import column_quantiles, grouped_quantiles, running_sums
from kestrel.session import cut_lineage


def _stack(cols, values_fn, names) -> str:
    """``stack(n, 'c1', v1.., 'c2', v2..) as (column_name, names...)`` text."""
    parts = []
    for c in cols:
        parts.append(f"'{c}'")
        parts += values_fn(c)
    return f"stack({len(cols)}, {', '.join(parts)}) as (column_name, {', '.join(names)})"


# G1 ---------------------------------------------------------------------------
def overview(df: DataFrame) -> DataFrame:
    """Shape and per-column non-null counts (``df.info()``), one row per column."""
    cols = df.columns
    agg = df.agg(F.count("*").alias("__n"),
                 *[F.count(F.col(f"`{c}`")).alias(f"nn{i}") for i, c in enumerate(cols)])
    st = ", ".join(f"'{c}', {i}, __n, nn{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {st}) as (column_name, ordinal, n_rows, n_non_null)")


def head(df: DataFrame, n: int = 5, order_by=None) -> DataFrame:
    """First rows by a key (deterministic, unlike an unordered limit)."""
    return df.orderBy(*(order_by or df.columns[:1])).limit(n)


# G2 ---------------------------------------------------------------------------
def describe_numeric(df: DataFrame, cols=None) -> DataFrame:
    """count, mean, std (sample), min, 25 %, 50 %, 75 %, max per numeric column."""
    cols = cols or SC.numeric_columns(df)
    q = column_quantiles(df, cols, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        for j, v in enumerate(q[c]):
            aggs.append(F.lit(v).cast("double").alias(f"q{j}_{i}"))
    row = df.agg(*aggs)
    idx = {c: i for i, c in enumerate(cols)}
    st = _stack(cols, lambda c: [f"n{idx[c]}", f"m{idx[c]}", f"s{idx[c]}", f"lo{idx[c]}",
                                 f"q0_{idx[c]}", f"q1_{idx[c]}", f"q2_{idx[c]}", f"hi{idx[c]}"],
                ["count", "mean", "std", "min", "p25", "p50", "p75", "max"])
    return row.selectExpr(st)


def describe_text(df: DataFrame, cols=None) -> DataFrame:
    """count, unique, top (most frequent; ties: smallest), freq per text column.

    Two aggregates: (column, value) counts, then per column. No window.
    """
    cols = cols or SC.string_columns(df)
    st = _stack(cols, lambda c: [f"`{c}`"], ["value"])
    long = df.selectExpr(st).where(F.col("value").isNotNull())
    vc = long.groupBy("column_name", "value").agg(F.count("*").alias("cnt"))
    return vc.groupBy("column_name").agg(
        F.sum("cnt").alias("count"), F.count("*").alias("unique"),
        F.min_by("value", F.struct(-F.col("cnt"), F.col("value"))).alias("top"),
        F.max("cnt").alias("freq"))


# G3 ---------------------------------------------------------------------------
def missing_report(df: DataFrame) -> DataFrame:
    """Null count and share per column, only columns with nulls."""
    cols = df.columns
    agg = df.agg(F.count("*").alias("__n"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"z{i}") for i, c in enumerate(cols)])
    st = ", ".join(f"'{c}', z{i}" for i, c in enumerate(cols))
    long = agg.selectExpr("__n", f"stack({len(cols)}, {st}) as (column_name, n_missing)")
    return (long.where(F.col("n_missing") > 0)
            .select("column_name", "n_missing", (F.col("n_missing") / F.col("__n")).alias("share_missing")))


# G5 ---------------------------------------------------------------------------
def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between min and max (numpy layout: last bin closed);
    empty bins included. Output: bin, lower, upper, count."""
    x = F.col(col).cast("double")
    st = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = st["lo"], st["hi"]
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin bigint, lower double, upper double, count bigint")
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    b = F.least(F.floor((x - F.lit(lo)) * F.lit(bins / (hi - lo))), F.lit(bins - 1)).cast("bigint")
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count("*").alias("count"))
    grid = (df.limit(1).select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
            .withColumn("bin", F.col("bin").cast("bigint")))
    return (grid.join(F.broadcast(counts), "bin", "left")
            .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
                    F.coalesce("count", F.lit(0)).alias("count")))


# G6 ---------------------------------------------------------------------------
EXACT_VALUES = 200_000
_REACH = 8.5    # bandwidths; beyond it a kernel is below 1e-15 of its peak


def kde(df: DataFrame, col: str, points: int = 200, resolution: float | None = None,
        exact_values: int = EXACT_VALUES, error: float = 1e-6) -> DataFrame:
    """Gaussian kernel density on an even grid over [min, max], Scott's
    bandwidth (n^-1/5 times the sample deviation).

    The kernel sum runs over distinct values with their counts. A column with more
    than about ``exact_values`` of them is binned first: each value gives its weight to
    the two ends of its bin, by nearness. That changes a kernel by at most
    width^2 / (8 bandwidth^2) of its peak, and the width is chosen so that this is
    ``error``; the number of bins follows from the range in bandwidths, not from the
    values. ``resolution`` rounds values to that step instead. A value meets only the
    grid points within its kernel's reach.
    """
    x = nan_to_null(F.col(col).cast("double"))
    st = df.agg(F.count(x).alias("n"), F.stddev_samp(x).alias("sd"), F.min(x).alias("lo"), F.max(x).alias("hi"),
                F.approx_count_distinct(x).alias("distinct")).first()
    n, sd, lo, hi = st["n"], st["sd"], st["lo"], st["hi"]
    if not n or sd is None or sd == 0 or math.isnan(sd):
        return df.sparkSession.createDataFrame([], "point bigint, x double, density double")
    bw = sd * n ** (-0.2)
    step = (hi - lo) / (points - 1)
    given = df.where(x.isNotNull())
    if resolution is not None:
        v = F.round(x / F.lit(resolution)) * F.lit(resolution)
        vals = given.groupBy(v.alias("v")).agg(F.count("*").cast("double").alias("c"))
    elif st["distinct"] <= exact_values:
        vals = given.groupBy(x.alias("v")).agg(F.count("*").cast("double").alias("c"))
    else:
        width = bw * math.sqrt(8 * error)
        place = (x - F.lit(lo)) / F.lit(width)
        left = F.floor(place)
        # Sums of counts and of fractions per bin first; then both ends of a bin.
        bins = given.groupBy(left.alias("b")).agg(F.count("*").cast("double").alias("n"), F.sum(place - left).alias("f"))
        ends = F.explode(F.array(F.struct(F.col("b").alias("b"), (F.col("n") - F.col("f")).alias("c")), F.struct((F.col("b") + 1).alias("b"), F.col("f").alias("c")))).alias("e")
        vals = bins.select(ends).groupBy((F.lit(lo) + F.col("e.b") * F.lit(width)).alias("v")).agg(F.sum("e.c").alias("c"))
    first = F.greatest(F.ceil((F.col("v") - F.lit(lo + _REACH * bw)) / F.lit(step)), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("v") - F.lit(lo - _REACH * bw)) / F.lit(step)), F.lit(points - 1)).cast("int")
    met = vals.withColumns({"first": first, "last": last}).where("first <= last")
    grid = met.select("v", "c", F.explode(F.sequence("first", "last")).alias("point"))
    gx = F.lit(lo) + F.col("point") * F.lit(step)
    z = (gx - F.col("v")) / F.lit(bw)
    sums = grid.groupBy("point").agg(F.sum(F.col("c") * F.exp(F.lit(-0.5) * z * z)).alias("s"))
    norm = 1.0 / (n * bw * math.sqrt(2 * math.pi))
    every = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    return (every.join(F.broadcast(sums), "point", "left")   # at most ``points`` rows
            .select(F.col("point").cast("bigint").alias("point"), (F.lit(lo) + F.col("point") * F.lit(step)).alias("x"),
                    (F.coalesce("s", F.lit(0.0)) * F.lit(norm)).alias("density")))


# G7 ---------------------------------------------------------------------------
def count_by_class(df: DataFrame, col: str, label_col: str = "class") -> DataFrame:
    return df.groupBy(col, label_col).agg(F.count("*").alias("n"))


# G8 ---------------------------------------------------------------------------
def box_stats(df: DataFrame, col: str, label_col: str = "class") -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (most extreme values inside the fences) and
    outlier counts per class. Quartiles are exact per class; the whiskers
    and outlier counts are one conditional ``groupBy`` pass."""
    q = grouped_quantiles(df, label_col, col, [0.25, 0.5, 0.75])
    if not q:
        return df.sparkSession.createDataFrame(
            [], f"{label_col} bigint, q1 double, median double, q3 double, lower_whisker double, "
                "upper_whisker double, n_outliers bigint")
    x = F.col(col).cast("double")

    def per_class(i):
        e = None
        for g, vals in q.items():
            cond = F.col(label_col) == F.lit(g)
            e = F.when(cond, F.lit(vals[i])) if e is None else e.when(cond, F.lit(vals[i]))
        return e.cast("double")

    q1, med, q3 = per_class(0), per_class(1), per_class(2)
    lo_f = q1 - F.lit(1.5) * (q3 - q1)
    hi_f = q3 + F.lit(1.5) * (q3 - q1)
    inside = (x >= lo_f) & (x <= hi_f)
    return (df.where(x.isNotNull() & F.col(label_col).isNotNull())
            .groupBy(label_col)
            .agg(F.first(q1).alias("q1"), F.first(med).alias("median"), F.first(q3).alias("q3"),
                 F.min(F.when(inside, x)).alias("lower_whisker"),
                 F.max(F.when(inside, x)).alias("upper_whisker"),
                 F.count_if(~inside).alias("n_outliers")))


# G10 --------------------------------------------------------------------------
FEW_COLUMNS = 12
MERGE_WAYS = 64


def correlation(df: DataFrame, cols=None) -> DataFrame:
    """Pearson correlation of every pair (pairwise complete rows, NaN is missing), long
    form. Few columns are one aggregate per pair of different columns; more are one
    matrix of cross moments (``cross_moments``), so a thousand columns are one pass."""
    cols = list(cols or SC.numeric_columns(df))
    x = {c: nan_to_null(F.col(f"`{c}`").cast("double")) for c in cols}
    if len(cols) > FEW_COLUMNS:
        return _moment_correlation(df.select(*[x[c].alias(c) for c in cols]), cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    agg = df.agg(*[F.corr(x[a], x[b]).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    both = F.explode(F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))).alias("p")
    st = ", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs))
    return (agg.selectExpr(f"stack({len(pairs)}, {st}) as (a, b, corr)").select(both, "corr")
            .select(F.col("p.a").alias("col_a"), F.col("p.b").alias("col_b"), "corr"))


def _moment_batches(center: np.ndarray, scale: np.ndarray):
    """The task's moments: per column i, counts, sums, sums of squares and products
    with every column over the rows in which both have a value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, len(center), len(center)))
        for batch in batches:
            there = np.column_stack([np.asarray(c.is_valid()) for c in batch.columns]).astype(np.float64)
            value = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
            z = (value - center) / scale * there
            total += np.stack([there.T @ there, z.T @ there, (z * z).T @ there, z.T @ z])
        flat = [pa.array(list(m)) for m in total]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(center), dtype=np.int32)), *flat], names=["i", "n", "s", "q", "p"])
    return run


_MOMENTS = "i int, n array<double>, s array<double>, q array<double>, p array<double>"


def _added(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The arrays of one group, added as they arrive."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for c in ("n", "s", "q", "p"):
            part = np.sum(np.vstack(batch.column(c).to_numpy(zero_copy_only=False)), axis=0)
            total[c] = total[c] + part if c in total else part
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), *[pa.array([v]) for v in total.values()]], names=["i", *total])


def cross_moments(df: DataFrame, center: np.ndarray, scale: np.ndarray) -> DataFrame:
    """One row per column i: arrays over the columns j of the number of rows with both,
    and of the sums of z_i, z_i^2 and z_i z_j over them, where z is the standardised
    value. Tasks make them as matrix products; they are added in two rounds, so that no
    group holds the rows of more than a share of the tasks."""
    parts = df.mapInArrow(_moment_batches(center, scale), _MOMENTS).withColumn("way", F.pmod(F.spark_partition_id(), F.lit(MERGE_WAYS)))
    some = parts.groupBy("i", "way").applyInArrow(_added, _MOMENTS)
    return some.groupBy("i").applyInArrow(_added, _MOMENTS)


def _moment_correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    # A first pass for means and deviations, so that the moments are well-conditioned.
    st = df.agg(*[F.avg(f"`{c}`").alias(f"m{i}") for i, c in enumerate(cols)], *[F.stddev_pop(f"`{c}`").alias(f"d{i}") for i, c in enumerate(cols)]).first()
    center = np.array([st[f"m{i}"] or 0.0 for i in range(len(cols))])
    scale = np.array([st[f"d{i}"] or 1.0 for i in range(len(cols))])
    m = cross_moments(df, center, scale)
    # z_j over the rows with both is column j's moment with i.
    pair = m.select("i", F.posexplode(F.arrays_zip("n", "s", "q", "p")).alias("j", "x")).select("i", "j", "x.*")
    other = pair.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col("s").alias("sj"), F.col("q").alias("qj"))
    both = pair.join(other, ["i", "j"])
    n = F.col("n")
    vi, vj = F.col("q") - F.col("s") * F.col("s") / n, F.col("qj") - F.col("sj") * F.col("sj") / n
    known = (n > 1) & (vi > 1e-12 * n) & (vj > 1e-12 * n)
    corr = F.when(known, F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise((F.col("p") - F.col("s") * F.col("sj") / n) / F.sqrt(vi * vj)))
    names = F.array(*[F.lit(c) for c in cols])
    return both.select(F.get(names, F.col("i")).alias("col_a"), F.get(names, F.col("j")).alias("col_b"), corr.alias("corr"))


# G11 / G12 ----------------------------------------------------------------------
def _chi2_sf(x: float, k: int) -> float:
    """Survival function of the chi-square distribution (regularized upper
    incomplete gamma Q(k/2, x/2)); series / continued fraction."""
    if x <= 0:
        return 1.0
    a, z = k / 2.0, x / 2.0
    if k == 1:
        return math.erfc(math.sqrt(z))
    gln = math.lgamma(a)
    if z < a + 1:
        s, term, n = 1.0 / a, 1.0 / a, 0
        while abs(term) > abs(s) * 1e-15 and n < 10_000:
            n += 1
            term *= z / (a + n)
            s += term
        return max(0.0, 1.0 - s * math.exp(-z + a * math.log(z) - gln))
    b, c, d = z + 1 - a, 1e300, 1.0 / (z + 1 - a)
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return math.exp(-z + a * math.log(z) - gln) * h


def kruskal_ranks(df: DataFrame, col: str, group_col: str) -> DataFrame:
    """Rank sums per group with mid-ranks for ties, plus the tie term.

    Counts per (value, group) -> distinct values with a distributed running
    count -> mid-rank of each value -> rank sum per group. Output: one row per
    group (g, n, rank_sum, tie_term = 0) and one row (NULL, NULL, NULL,
    tie_term) holding the data-wide sum of t^3 - t over tied values.
    """
    x = F.col(col).cast("double")
    base = df.where(x.isNotNull() & F.col(group_col).isNotNull())
    # Read three times below; made once.
    vg = cut_lineage(base.groupBy(x.alias("v"), F.col(group_col).alias("g")).agg(F.count("*").alias("c")))
    vt = vg.groupBy("v").agg(F.sum("c").alias("t"))
    cum = running_sums(vt, "v", ["t"])
    ranks = cum.select("v", (F.col("t_cum") - F.col("t") + (F.col("t") + 1) / 2.0).alias("r"))
    per_group = (vg.join(ranks, "v").groupBy("g")
                 .agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("r")).alias("rank_sum"))
                 .withColumn("tie_term", F.lit(0.0)))
    ties = vt.agg(F.sum(F.col("t").cast("double") ** 3 - F.col("t")).alias("tie_term"))
    return per_group.unionByName(ties, allowMissingColumns=True)


def kruskal_table(df: DataFrame, col: str, group_col: str) -> DataFrame:
    """H statistic (tie-corrected) as a one-row table: h, dof, n_total and
    groups_ok (at least two groups, each with more than one value)."""
    r = kruskal_ranks(df, col, group_col)
    agg = r.agg(F.sum("n").cast("double").alias("N"),
                F.sum(F.col("rank_sum") ** 2 / F.col("n")).alias("S"),
                F.sum("tie_term").alias("T"), F.count("n").alias("k"),
                F.min("n").alias("min_n"))
    h = ((F.lit(12.0) / (F.col("N") * (F.col("N") + 1)) * F.col("S") - 3 * (F.col("N") + 1))
         / (F.lit(1.0) - F.col("T") / (F.col("N") ** 3 - F.col("N"))))
    return agg.select(h.alias("h"), (F.col("k") - 1).alias("dof"),
                      F.col("N").cast("bigint").alias("n_total"),
                      ((F.col("k") >= 2) & (F.col("min_n") > 1)).cast("int").alias("groups_ok"))


def kruskal_wallis(df: DataFrame, col: str, group_col: str) -> dict:
    """H, degrees of freedom, p-value (chi-square survival) and the G12 guard:
    ``valid`` unless fewer than two groups or a group with one value;
    ``significant`` is p < 0.05 on a valid test."""
    row = kruskal_table(df, col, group_col).first()
    out = {"h": row["h"], "dof": row["dof"], "n_total": row["n_total"],
           "valid": bool(row["groups_ok"]), "p_value": None, "significant": False}
    if row["h"] is not None and row["dof"] >= 1 and not math.isnan(row["h"]):
        out["p_value"] = _chi2_sf(row["h"], row["dof"])
        out["significant"] = bool(out["valid"] and out["p_value"] < 0.05)
    return out


# G9 ---------------------------------------------------------------------------
def fraud_rate_by_country(df: DataFrame, label_col: str = "class", country_col: str = "country",
                          top: int = 20) -> DataFrame:
    """Share of positive labels per country, highest first (ties by name), top N."""
    return (df.groupBy(country_col)
            .agg(F.avg(label_col).alias("fraud_rate"), F.count("*").alias("n_transactions"))
            .orderBy(F.desc("fraud_rate"), F.asc(country_col))
            .limit(top))


__all__ = ["overview", "head", "describe_numeric", "describe_text", "missing_report", "histogram",
           "kde", "count_by_class", "box_stats", "correlation", "kruskal_wallis", "kruskal_table",
           "fraud_rate_by_country"]
