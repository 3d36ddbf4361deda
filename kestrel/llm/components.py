"""Connected components of a link table, without gathering it anywhere.

Links are first contracted inside each task by union-find, which leaves at most
one link per node and task. Then large-star and small-star rounds alternate
until nothing changes: every node is linked with the smallest node it knows of.
Each round is one aggregation and one join on node ids; a hub with many links is
only ever a grouping key of a partial minimum and the skewed side of a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import written

_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_CONTRACT_AT = 500_000


def _union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its group) for every node that is not smallest itself."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(at[: len(a)].tolist(), at[len(a):].tolist()):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    roots = np.array([root(x) for x in range(len(nodes))], dtype=np.int64)
    other = roots != np.arange(len(nodes))
    return nodes[other], nodes[roots[other]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held_a, held_b, n = [], [], 0

    def flush():
        a, b = _union_find(np.concatenate(held_a), np.concatenate(held_b))
        held_a.clear()
        held_b.clear()
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=_LINKS)

    for batch in batches:
        held_a.append(batch.column(0).to_numpy(zero_copy_only=False))
        held_b.append(batch.column(1).to_numpy(zero_copy_only=False))
        n += batch.num_rows
        if n >= _CONTRACT_AT:
            n = 0
            yield flush()
    if n:
        yield flush()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a
    link to another and is not itself the smallest.

    ``a`` and ``b`` are bigint columns without nulls. Each round that changes
    anything lowers some node's smallest neighbour, so the loop ends; chains
    halve in length, so the rounds grow with the logarithm of the longest one.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    # (node, smaller neighbour), one row per link.
    down = written(pairs.mapInArrow(_contract, "a bigint, b bigint").distinct(), "links")
    if down.isEmpty():
        return down.select(F.col("a").alias("node"), F.col("b").alias("component"))
    while True:
        # Large star: a node's larger neighbours move to its smallest neighbour.
        both = down.union(down.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("n")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), "links")
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("k")).select(F.col("a").alias("n"), "m", "k")
        moved = large.join(least, F.col("a") == F.col("n"))
        small = moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = written(small.union(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct(), "links")
        # Done when every node has one parent and no parent has a parent.
        rows = small.agg(F.count("*").alias("n"), F.count_distinct("a").alias("d")).first()
        if rows["n"] == rows["d"] and small.join(small.select(F.col("a").alias("p")), F.col("b") == F.col("p"), "left_semi").isEmpty():
            return small.select(F.col("a").alias("node"), F.col("b").alias("component"))
        down = small
