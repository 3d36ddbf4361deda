"""Per-row explanations (H9) and global importance.

Linear models: exact contributions w * (x - mean) (``metrics.linear_contributions``).

Other models (trees): sampled Shapley values. For each explained row, each
of ``permutations`` feature orders (from a hash of row, permutation and
feature; no ``rand()``) and each of ``background`` reference rows, the
features are switched from the reference's value to the row's value one at a
time; the change of the model output at each switch is credited to that
feature, and credits are averaged. The credits of one row add up exactly to
f(row) - mean f(background).

Tree ensembles are scored where the row is: their arrays go to the tasks
(``functions.trees``), a task makes the hybrid points of a few rows at a time in
numpy, and only the d credits of a row leave it, so there is no shuffle and any
number of rows can be explained. The work is rows x permutations x references x
(d + 1) model evaluations.

Any other Spark ML classifier is scored by its own ``transform``: hybrid points are
rows, differenced with a ``lag`` inside (row, permutation, reference) groups and
averaged with one ``groupBy``; that is meant for the rows that matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.trees import TreeArrays

# The exact linear forms live with the metrics; re-exported here as the H9/H10 entry points.
from kestrel.operators.metrics import global_importance, linear_contributions  # noqa: F401


def background_sample(df: DataFrame, feature_cols, n: int = 8, key_cols=None,
                      seed: int = 42) -> DataFrame:
    """``n`` reference rows chosen by the smallest hash of their key (a bounded
    top-n, deterministic)."""
    keys = [F.col(c) for c in (key_cols or feature_cols)]
    h = F.xxhash64(*keys, F.lit(seed))
    return (df.select(F.array(*[F.col(c).cast("double") for c in feature_cols]).alias("bvec"),
                      h.alias("__h"))
            .orderBy("__h").limit(n)
            .select(F.row_number().over(Window.orderBy("__h")).alias("bid"), "bvec"))


POINTS_AT_ONCE = 200_000


def _credit_batches(trees: TreeArrays, background: np.ndarray):
    """Rows (x, orders) to the mean credit of each feature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_ref, d = background.shape
        masks = trees.masks(d)
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            orders = batch.column("orders").flatten().flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1, d)
            n_perm = orders.shape[1]
            phi = np.zeros((len(x), d))
            step = max(1, POINTS_AT_ONCE // (n_perm * n_ref * (d + 1)))
            for lo in range(0, len(x), step):
                some, turn = x[lo: lo + step], orders[lo: lo + step]
                f = _on_path(trees, masks, some, turn, background) if masks else _at_points(trees, some, turn, background)
                gain = np.diff(f, axis=3).mean(axis=2)            # rows, permutations, steps
                np.add.at(phi, (np.arange(lo, lo + len(some))[:, None, None], turn), gain / n_perm)
            credits = pa.ListArray.from_arrays(pa.array(np.arange(0, phi.size + 1, d, dtype=np.int32)), pa.array(phi.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("rid"), credits], names=["rid", "phi"])
    return run


def _at_points(trees: TreeArrays, x: np.ndarray, turn: np.ndarray, background: np.ndarray) -> np.ndarray:
    """P(class 1) by row, permutation, reference and number of features switched."""
    d = background.shape[1]
    place = np.argsort(turn, axis=2)                  # when each feature is switched
    switched = place[:, :, None, None, :] < np.arange(d + 1)[:, None]
    points = np.where(switched, x[:, None, None, None, :], background[None, None, :, None, :])
    return trees.probability(points.reshape(-1, d)).reshape(points.shape[:4])


def _on_path(trees: TreeArrays, masks: list, x: np.ndarray, turn: np.ndarray, background: np.ndarray) -> np.ndarray:
    """``_at_points`` without the points: of the leaf words of a tree, those of the
    switched features come from the row and the others from the reference."""
    rows, n_perm, d = turn.shape
    order = np.ascontiguousarray(turn.transpose(2, 1, 0))       # rows last: long inner loops
    total = np.zeros((d + 1, len(background), n_perm, rows))
    at = np.arange(rows)
    for tree, weight in zip(masks, trees.weights):
        mine = np.bitwise_and.accumulate(tree.of(x)[at, order], axis=0)
        theirs = np.bitwise_and.accumulate(tree.of(background)[:, order[::-1]], axis=1)
        # No feature switched is the reference, all of them the row.
        total[0] += weight * tree.values(theirs[:, d - 1, :1, :1])
        total[d] += weight * tree.values(mine[d - 1, 0])
        for j in range(1, d):
            found = tree.values(theirs[:, d - 1 - j] & mine[j - 1])
            total[j] += found if weight == 1.0 else weight * found
    total = total.transpose(3, 2, 1, 0)
    if trees.boosted:
        return 1.0 / (1.0 + np.exp(-2.0 * total))
    return total / trees.weights.sum()


def _tree_credits(trees: TreeArrays, rows: DataFrame, background: np.ndarray, permutations: int, seed: int) -> DataFrame:
    d = background.shape[1]
    order = lambda p: F.transform(F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(d - 1)), lambda i: F.struct(
        F.xxhash64(F.col("rid"), F.lit(p), i, F.lit(seed)).alias("h"), i.alias("i")))), lambda s: s["i"])
    asked = rows.select("rid", "x", F.array(*[order(p) for p in range(permutations)]).alias("orders"))
    kind = rows.schema["rid"].dataType.simpleString()
    return asked.mapInArrow(_credit_batches(trees, background), f"rid {kind}, phi array<double>")


def sampled_shapley(classifier, df: DataFrame, feature_cols, background: DataFrame,
                    key_col: str, permutations: int = 4, seed: int = 42,
                    output_col: str = "probability", top: int | None = 5) -> DataFrame:
    """Sampled Shapley credits of P(class 1) for a fitted Spark ML classifier
    that reads a ``features`` vector. Output: (key, rank, feature,
    contribution, base_value, prediction); all features when ``top`` is None.
    """
    d = len(feature_cols)
    names = F.array(*[F.lit(c) for c in feature_cols])
    rows = df.select(F.col(key_col).alias("rid"),
                     F.array(*[F.col(c).cast("double") for c in feature_cols]).alias("x"))
    trees = TreeArrays.of(df.sparkSession, classifier) if output_col == "probability" else None
    if trees is not None:
        ref = np.array([r["bvec"] for r in background.orderBy("bid").collect()], dtype=np.float64)
        if not len(ref):
            raise ValueError("empty background sample")
        found = _tree_credits(trees, rows, ref, permutations, seed)
        items = F.zip_with(names, "phi", lambda n, v: F.struct(F.abs(v).alias("a"), n.alias("feature"), v.alias("contribution")))
        per_row = found.select("rid", F.sort_array(items, asc=False).alias("items"), F.aggregate("phi", F.lit(0.0), lambda a, v: a + v).alias("total"))
        return _listed(per_row, float(trees.probability(ref).mean()), key_col, top)
    perms = rows.select("rid", "x", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))).alias("p"))
    # Feature order of this (row, permutation): sort feature indexes by hash.
    order = F.transform(
        F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(d - 1)),
                                 lambda i: F.struct(F.xxhash64(F.col("rid"), F.col("p"), i, F.lit(seed))
                                                    .alias("h"), i.alias("i")))),
        lambda s: s["i"])
    pos = F.transform(F.sequence(F.lit(0), F.lit(d - 1)), lambda i: F.array_position(order, i) - 1)
    perms = perms.select("rid", "x", "p", order.alias("order"), pos.alias("pos"))
    # The reference rows are a bounded sample (a few rows): inline them as a
    # literal array and explode it per (row, permutation) - no join.
    bg_rows = [r["bvec"] for r in background.orderBy("bid").collect()]
    if not bg_rows:
        raise ValueError("empty background sample")
    bg_lit = F.array(*[F.array(*[F.lit(float(v)).cast("double") for v in vec]) for vec in bg_rows])
    combos = perms.select("*", F.posexplode(bg_lit).alias("bid", "bvec"))
    steps = combos.select("rid", "p", "bid", "x", "bvec", "order", "pos",
                          F.explode(F.sequence(F.lit(0), F.lit(d))).alias("j"))
    z = F.transform(F.sequence(F.lit(0), F.lit(d - 1)),
                    lambda i: F.when(F.element_at("pos", i + 1) < F.col("j"),
                                     F.element_at("x", i + 1)).otherwise(F.element_at("bvec", i + 1)))
    pts = steps.select("rid", "p", "bid", "j", "order", array_to_vector(z).alias("features"))
    scored = classifier.transform(pts).select(
        "rid", "p", "bid", "j", "order", vector_to_array(F.col(output_col))[1].alias("f"))
    w = Window.partitionBy("rid", "p", "bid").orderBy("j")
    credit = (scored.select("rid", "j", "order", (F.col("f") - F.lag("f").over(w)).alias("delta"))
              .where(F.col("j") > 0)
              .select("rid", F.element_at("order", F.col("j")).alias("fi"), "delta"))
    phi = credit.groupBy("rid", "fi").agg(F.avg("delta").alias("contribution"))
    # Base value: the mean model output over the (few) reference rows.
    spark = df.sparkSession
    bg_df = spark.createDataFrame([(list(map(float, v)),) for v in bg_rows], "b array<double>")
    base = (classifier.transform(bg_df.select(array_to_vector("b").alias("features")))
            .agg(F.avg(vector_to_array(F.col(output_col))[1])).first()[0])
    named = phi.select("rid", F.element_at(names, F.col("fi") + 1).alias("feature"), "contribution")
    per_row = named.groupBy("rid").agg(
        F.sort_array(F.collect_list(F.struct(F.abs("contribution").alias("a"), F.col("feature"),
                                             F.col("contribution"))), asc=False).alias("items"),
        F.sum("contribution").alias("total"))
    return _listed(per_row, base, key_col, top)


def _listed(per_row: DataFrame, base: float, key_col: str, top: int | None) -> DataFrame:
    if top is not None:
        per_row = per_row.withColumn("items", F.slice("items", 1, top))
    # Credits telescope: base + sum of all credits = the model output on the row.
    return per_row.select("rid", "total", F.posexplode("items").alias("pos", "it")).select(
        F.col("rid").alias(key_col), (F.col("pos") + 1).alias("rank"),
        F.col("it.feature").alias("feature"), F.col("it.contribution").alias("contribution"),
        F.lit(base).alias("base_value"), (F.lit(base) + F.col("total")).alias("prediction"))


def importance_from_contributions(contrib: DataFrame) -> DataFrame:
    """H10 from per-row credits: mean absolute contribution per feature."""
    return contrib.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))
