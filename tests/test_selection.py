"""Exact order statistics of many columns and groups in a fixed number of passes."""

import numpy as np
import pytest

from kestrel.functions import selection as S
from kestrel.functions import stats as ST


def test_bits_follow_the_order_of_the_values():
    v = np.array([float("-inf"), -1e308, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1.0 + 2**-52, 1e308, float("inf")])
    u = S.ordered_bits(v)
    assert (u[1:] > u[:-1]).all() and [S.from_bits(int(x)) for x in u] == list(v)
    assert S.ordered_bits(np.array([-0.0]))[0] == S.ordered_bits(np.array([0.0]))[0]


def table(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(900):
        a = [0.0, float(rng.normal()), float(rng.integers(-5, 5)), 1e300 * float(rng.normal())][i % 4]
        rows.append((a, float("nan") if i % 17 == 0 else float(i % 23) / 7, None if i % 5 else float(rng.integers(0, 10**9)), ["x", "y", None][i % 3]))
    return rows, spark.createDataFrame(rows, "a double, `b c` double, d double, g string").repartition(4)


def test_every_rank_of_every_column(spark):
    rows, df = table(spark)
    valid = {c: sorted(r[k] for r in rows if r[k] is not None and not np.isnan(r[k])) for k, c in enumerate(("a", "b c", "d"))}
    ranks = {c: [0, 1, len(v) // 3, len(v) // 2, len(v) - 1] for c, v in valid.items()}
    got = S.select_ranks(df, list(valid), {(c, None): r for c, r in ranks.items()})
    assert got == {(c, None, r): valid[c][r] for c in valid for r in ranks[c]}


@pytest.mark.parametrize("small", [5, 10**6])
def test_quantiles_by_column_and_group(spark, small):
    rows, df = table(spark)
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = ST.column_quantiles(df, ["a", "b c", "d"], probs, small=small)
    for k, c in enumerate(("a", "b c", "d")):
        v = [r[k] for r in rows if r[k] is not None and not np.isnan(r[k])]
        assert got[c] == pytest.approx(list(np.quantile(v, probs)), rel=1e-12)
    by = ST.grouped_quantiles(df, "g", "b c", probs, small=small)
    assert set(by) == {"x", "y", None}
    for g in by:
        v = [r[1] for r in rows if r[3] == g and not np.isnan(r[1])]
        assert by[g] == pytest.approx(list(np.quantile(v, probs)), rel=1e-12)


def test_jobs_do_not_grow_with_columns_and_classes(spark):
    """The same number of Spark jobs for one column and for thirty in three groups."""
    from pyspark.sql import functions as F
    df = spark.range(3000).select(*[((F.col("id") * (i + 3)) % 997).cast("double").alias(f"x{i}") for i in range(30)], (F.col("id") % 3).alias("g"))
    tracker, sc, n = spark.sparkContext.statusTracker(), spark.sparkContext, []
    for cols in (1, 30):
        sc.setJobGroup(f"select-{cols}", "")
        ST.column_quantiles(df, [f"x{i}" for i in range(cols)], [0.5], small=10)
        n.append(len(tracker.getJobIdsForGroup(f"select-{cols}")))
    sc.setJobGroup("", "")
    assert n[1] <= n[0] + 2


def test_empty_columns(spark):
    df = spark.createDataFrame([(None, 1.0)] * 3, "a double, b double")
    assert ST.column_quantiles(df, ["a", "b"], [0.5], small=1) == {"a": [None], "b": [1.0]}
