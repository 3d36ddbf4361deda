"""Fitted tree ensembles as arrays, scored in numpy inside a task."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import DecisionTreeClassificationModel, GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from kestrel.session import scratch_path


@dataclass
class TreeArrays:
    """Nodes of all trees in one row of arrays; leaves have feature -1."""

    roots: np.ndarray       # index of each tree's root
    weights: np.ndarray     # of each tree
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray       # of a leaf: share of class 1, or the prediction of a boosted tree
    boosted: bool

    @classmethod
    def of(cls, spark: SparkSession, model) -> "TreeArrays | None":
        """The arrays of a fitted tree classifier with two classes and numbers only;
        None for any other model. They are read from the model's saved form, whose
        size is that of the model."""
        kinds = (DecisionTreeClassificationModel, RandomForestClassificationModel, GBTClassificationModel)
        if not isinstance(model, kinds) or model.numClasses != 2:
            return None
        path = scratch_path(spark, "trees")
        model.write().save(path)
        saved = spark.read.parquet(f"{path}/data")
        if "nodeData" in saved.columns:
            saved = saved.select("treeID", "nodeData.*")
        else:
            saved = saved.withColumn("treeID", F.lit(0))
        nodes = saved.orderBy("treeID", "id").collect()
        if any(n["split"]["numCategories"] >= 0 for n in nodes):
            return None
        start, place = {}, {}
        for i, n in enumerate(nodes):
            start.setdefault(n["treeID"], i)
            place[n["treeID"], n["id"]] = i
        boosted = isinstance(model, GBTClassificationModel)
        leaf = np.array([n["leftChild"] < 0 for n in nodes])
        own = np.arange(len(nodes))
        child = lambda side: np.array([i if n[side] < 0 else place[n["treeID"], n[side]] for i, n in enumerate(nodes)])
        share = [n["prediction"] if boosted else n["impurityStats"][1] / sum(n["impurityStats"]) for n in nodes]
        weights = model.treeWeights if not isinstance(model, DecisionTreeClassificationModel) else [1.0]
        return cls(np.array([start[t] for t in sorted(start)]), np.array(weights, dtype=np.float64),
                   np.where(leaf, -1, [n["split"]["featureIndex"] for n in nodes]),
                   np.array([n["split"]["leftCategoriesOrThreshold"][0] if n["leftChild"] >= 0 else 0.0 for n in nodes]),
                   np.where(leaf, own, child("leftChild")), np.where(leaf, own, child("rightChild")), np.array(share, dtype=np.float64), boosted)

    def probability(self, x: np.ndarray) -> np.ndarray:
        """P(class 1) of each row."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for root, weight in zip(self.roots, self.weights):
            at = np.full(len(x), root)
            open_ = rows
            while len(open_):
                node = at[open_]
                feature = self.feature[node]
                inner = feature >= 0
                open_, node, feature = open_[inner], node[inner], feature[inner]
                goes_left = x[open_, feature] <= self.threshold[node]
                at[open_] = np.where(goes_left, self.left[node], self.right[node])
            total += weight * self.value[at]
        if self.boosted:
            return 1.0 / (1.0 + np.exp(-2.0 * total))
        return total / self.weights.sum()

    def masks(self, n_features: int) -> "list[LeafMasks] | None":
        """One ``LeafMasks`` per tree; None where a tree has more leaves than a word has bits."""
        out = [LeafMasks(self, root, n_features) for root in self.roots]
        return None if any(len(m.value) > 64 for m in out) else out


class LeafMasks:
    """A tree of at most 64 leaves, evaluated a feature at a time.

    Leaves are numbered from left to right. A node sends a value above its threshold to
    the right, which rules out the leaves on its left; what all nodes of a feature rule
    out depends on how many of its thresholds lie below the value. The leaf of a point
    is the first that no feature rules out, so points mixed from two rows need the words
    of the two rows only.
    """

    def __init__(self, trees: TreeArrays, root: int, n_features: int):
        leaves: list[float] = []
        cuts: list[list[tuple[float, int]]] = [[] for _ in range(n_features)]

        def walk(node: int) -> None:
            if trees.feature[node] < 0:
                leaves.append(trees.value[node])
                return
            first = len(leaves)
            walk(trees.left[node])
            gone = ((1 << len(leaves)) - 1) ^ ((1 << first) - 1)
            cuts[trees.feature[node]].append((float(trees.threshold[node]), gone))
            walk(trees.right[node])

        walk(root)
        self.value = np.array(leaves)
        self.kind = next((k for k in (np.uint8, np.uint16, np.uint32) if len(leaves) <= 8 * k().nbytes), np.uint64)
        self.thresholds, self.words = [], []
        for mine in cuts:
            mine.sort()
            words = [int(np.iinfo(self.kind).max)]
            for _, gone in mine:
                words.append(words[-1] & ~gone)
            self.thresholds.append(np.array([t for t, _ in mine]))
            self.words.append(np.array(words, dtype=self.kind))

    def of(self, x: np.ndarray) -> np.ndarray:
        """A word per row and feature: the leaves that the feature leaves open."""
        out = np.empty(x.shape, dtype=self.kind)
        for f, (t, w) in enumerate(zip(self.thresholds, self.words)):
            out[:, f] = w[np.searchsorted(t, x[:, f], side="left")]   # NaN lies above all, as in a comparison
        return out

    def values(self, words: np.ndarray) -> np.ndarray:
        """The leaf value of each point, from its features' words joined by and."""
        one = self.kind(1)
        return self.value[np.bitwise_count((words - one) & ~words)]
