"""Stratified folds (H4), tree credits without a shuffle (H9), cross moments (G10),
binned density (G6)."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from kestrel.functions.trees import TreeArrays
from kestrel.operators import explain as EX
from kestrel.operators import profile as P
from kestrel.plans import models as ML


def test_folds_hold_each_class_within_one_row(spark):
    rows = [(i, [0, 0, 0, 1, None][i % 5] if i < 490 else 2) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, y int")
    for folds in (2, 3, 5):
        out = ML.stratified_folds(df, "y", ["id"], folds)
        assert sorted(r["id"] for r in out.collect()) == list(range(500))
        for y in (0, 1, 2):
            sizes = [out.where(f"y = {y} and fold = {k}").count() for k in range(folds)]
            assert max(sizes) - min(sizes) <= 1 and sum(sizes) == df.where(f"y = {y}").count()
    again = ML.stratified_folds(df.repartition(7), "y", ["id"], 3)
    assert sorted(again.collect(), key=str) == sorted(ML.stratified_folds(df, "y", ["id"], 3).collect(), key=str)


def data(spark, n=400):
    rng = np.random.default_rng(6)
    m = rng.normal(size=(n, 4)).round(2)
    return spark.createDataFrame([(i, *map(float, r), int(r[0] + r[1] * r[2] > 0.3)) for i, r in enumerate(m)], "k long, a double, b double, c double, d double, y int")


@pytest.mark.parametrize("estimator", [lambda: RandomForestClassifier(labelCol="y", numTrees=5, maxDepth=4, seed=1),
                                       lambda: GBTClassifier(labelCol="y", maxIter=4, maxDepth=3, seed=1), lambda: DecisionTreeClassifier(labelCol="y", maxDepth=4)])
def test_tree_credits_equal_those_of_the_model_itself(spark, monkeypatch, estimator):
    df, names = data(spark), ["a", "b", "c", "d"]
    model = ML.fit(estimator(), df, names)
    trees = TreeArrays.of(spark, model.stages[-1])
    scored = ML.with_probability(model, df, "p").orderBy("k").collect()
    x = np.array([[r[c] for c in names] for r in scored])
    assert np.allclose(trees.probability(x), [r["p"] for r in scored])
    bg = EX.background_sample(df, names, n=3, key_cols=["k"])
    some = df.where("k < 12")
    key = lambda r: (r["k"], r["feature"])
    fast = EX.sampled_shapley(model.stages[-1], some, names, bg, "k", permutations=3, top=None)
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    fast = sorted(fast.collect(), key=key)
    monkeypatch.setattr(EX.TreeArrays, "of", classmethod(lambda cls, spark, m: None))
    slow = sorted(EX.sampled_shapley(model.stages[-1], some, names, bg, "k", permutations=3, top=None).collect(), key=key)
    assert len(fast) == len(slow) == 48
    for f, s in zip(fast, slow):
        assert key(f) == key(s)
        assert f["contribution"] == pytest.approx(s["contribution"], abs=1e-9) and f["prediction"] == pytest.approx(s["prediction"], abs=1e-9)


def test_rows_that_share_a_key_are_explained_apart(spark):
    df, names = data(spark), ["a", "b", "c", "d"]
    model = ML.fit(RandomForestClassifier(labelCol="y", numTrees=3, maxDepth=3, seed=1), df, names)
    same = df.where("k < 4").withColumn("k", F.lit(1).cast("long"))
    out = EX.sampled_shapley(model.stages[-1], same, names, EX.background_sample(df, names, n=2, key_cols=["k"]), "k", permutations=2, top=1)
    assert out.count() == 4


def test_cross_moments_equal_pairwise_correlation(spark, monkeypatch):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(500, 20)) * 10.0 ** rng.integers(-3, 6, 20) + 1e6
    m[:, 5] = m[:, 4] * 2 + 1
    m[rng.random(m.shape) < 0.1] = np.nan
    m[:, 7] = 4.0
    m[:, 8] = np.nan
    names = [f"c {i}" for i in range(20)]
    df = spark.createDataFrame([tuple(None if math.isnan(v) and i % 2 else float(v) for i, v in enumerate(r)) for r in m], ", ".join(f"`{n}` double" for n in names))
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in P.correlation(df.repartition(5)).collect()}
    assert len(got) == 400
    for i in range(20):
        for j in range(20):
            both = ~np.isnan(m[:, i]) & ~np.isnan(m[:, j])
            x, y = m[both, i], m[both, j]
            if len(x) < 2 or x.std() == 0 or y.std() == 0:
                assert got[names[i], names[j]] is None
            else:
                assert got[names[i], names[j]] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-8)
    monkeypatch.setattr(P, "FEW_COLUMNS", 3)
    four = df.select(*[f"`{n}`" for n in names[:5]])
    many = {(r["col_a"], r["col_b"]): r["corr"] for r in P.correlation(four).collect()}
    monkeypatch.setattr(P, "FEW_COLUMNS", 30)
    few = {(r["col_a"], r["col_b"]): r["corr"] for r in P.correlation(four).collect()}
    assert many.keys() == few.keys() and all(many[k] == pytest.approx(few[k], abs=1e-5) for k in few)


def test_two_hundred_columns_in_one_matrix(spark):
    df = spark.range(2000).select(*[((F.col("id") * (7 + i)) % 1009).cast("double").alias(f"x{i}") for i in range(200)])
    out = P.correlation(df)
    assert out.count() == 40_000 and out.where("col_a = col_b and abs(corr - 1) > 1e-9").count() == 0


def test_binned_density_keeps_its_error(spark):
    rng = np.random.default_rng(4)
    v = np.concatenate([rng.normal(0, 1, 3000), rng.normal(7, 0.2, 1000), [40.0]])
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,), (float("nan"),)], "x double")
    exact = {r["point"]: r["density"] for r in P.kde(df, "x").collect()}
    bw = v.std(ddof=1) * len(v) ** -0.2
    grid = np.linspace(v.min(), v.max(), 200)
    want = np.exp(-0.5 * ((grid[:, None] - v) / bw) ** 2).sum(axis=1) / (len(v) * bw * math.sqrt(2 * math.pi))
    assert np.allclose([exact[k] for k in range(200)], want, atol=1e-12)
    peak = 1 / (bw * math.sqrt(2 * math.pi))
    for error in (1e-4, 1e-6):
        binned = {r["point"]: r["density"] for r in P.kde(df, "x", exact_values=10, error=error).collect()}
        assert max(abs(binned[k] - want[k]) for k in range(200)) <= error * peak
    assert P.kde(df.where("x = 40"), "x").count() == 0
