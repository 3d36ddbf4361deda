"""Approximate nearest neighbours on shifted Hilbert curves (operator 5).

1. Equal vectors are one point, which keeps its few smallest ids; the others
   follow from them, since equal vectors tie and ties go to the smaller id.
2. Each of ``orders`` orderings projects the unit vectors on a few random
   orthogonal directions, shifts them on a grid and sorts the points by their
   place on the Hilbert curve of the grid. Spark range-partitions all orderings
   together; a point's rank is its place in its partition plus the sizes of the
   partitions before.
3. *Window width.* For a bounded sample of queries (``sample``) the true
   neighbours are found by brute force. The width is the rank distance within
   which ``aim`` of them lie in some ordering, times ``margin``. Every point is
   indexed; only the width is fitted.
4. Ranks are cut in blocks of ``block_rows``, whatever the width, each with the
   vectors of its points; a query goes to every block that its window, the points
   ``width`` before and after it in each ordering, reaches. There the ``k`` best
   points by the exact cosine in double precision stay. Single precision only
   leaves out points that its error bound rules out, however close the points lie.
5. The windows of all orderings merge: the result is the ``k`` best of all points
   in a query's windows.

Vectors that are null, zero, or hold null or non-finite components, rows with a
null id and vectors of another length than the most common one take no part.
Ties go to the smaller id. Fewer neighbours than asked for are returned when
there are no more. Extra columns are ignored; repeated rows count once. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from kestrel.llm.common import written
from kestrel.llm.hilbert import hilbert_keys

ORDERS, DIMENSIONS, BITS = 48, 8, 8
SAMPLE, AIM, MARGIN, LEAST_WIDTH = 96, 0.95, 1.1, 64
BLOCK_ROWS, _QUERIES = 8192, 256
_REACH = 4.0  # grid limits, in standard deviations of a projected unit vector


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, vec) of the vectors that take part, and their length."""
    vec = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), vec.alias("vec")).where("id is not null and vec is not null")
            .where(finite & F.exists("vec", lambda x: x != 0)))
    sizes = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    dim = sizes["d"] if sizes else 0
    return rows.where(F.size("vec") == dim), dim


def _smallest_ids(keep: int, dim: int):
    """Per task, each distinct vector with its ``keep`` smallest ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[int]] = {}

        def flush():
            vecs = np.frombuffer(b"".join(held), dtype=np.float64)
            offsets = np.arange(len(held) + 1, dtype=np.int32) * dim
            out = pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(vecs)),
                                              pa.array(list(held.values()), pa.list_(pa.int64()))], names=["vec", "ids"])
            held.clear()
            return out

        for batch in batches:
            vecs = _matrix(batch.column(1), dim) + 0.0  # -0.0 becomes 0.0
            for i, v in zip(batch.column(0).to_pylist(), vecs):
                own = held.setdefault(v.tobytes(), [])
                if i not in own:
                    own.append(i)
                    own.sort()
                    del own[keep:]
            if len(held) > 50_000:
                yield flush()
        if held:
            yield flush()
    return run


def distinct_points(rows: DataFrame, dim: int, keep: int) -> DataFrame:
    """(point, vec, ids): a point is named by the smallest id of its vector."""
    parts = rows.mapInArrow(_smallest_ids(keep, dim), "vec array<double>, ids array<bigint>")
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep)
    return parts.groupBy("vec").agg(ids.alias("ids")).select(F.get("ids", F.lit(0)).alias("point"), "vec", "ids")


def _frames(dim: int, orders: int, dims: int, seed: int):
    """Per ordering: orthogonal directions and the shift of the grid."""
    rng = np.random.default_rng(seed)
    d = min(dims, dim)
    return [(np.linalg.qr(rng.standard_normal((dim, d)))[0], rng.uniform(0.0, 1.0, d)) for _ in range(orders)]


def _key_batches(dim: int, orders: int, dims: int, bits: int, seed: int):
    """Rows (point, query, vec) to one row per ordering with its key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = _frames(dim, orders, dims, seed)
        for batch in batches:
            vecs = _matrix(batch.column(2), dim)
            largest = np.abs(vecs).max(axis=1, keepdims=True)
            unit = vecs / largest
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            cells = 1 << bits
            for order, (directions, shift) in enumerate(frames):
                # A projected unit vector spreads by about 1 / sqrt(dim).
                place = (unit @ directions) * np.sqrt(dim)
                grid = ((place + _REACH) / (2 * _REACH + 1) + shift / (2 * _REACH + 1)) * cells
                keys = hilbert_keys(np.clip(grid, 0, cells - 1), bits)
                keys = (keys ^ np.uint64(1 << 63)).view(np.int64)  # signed order
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(vecs), order, dtype=np.int32)), pa.array(keys), batch.column(0), batch.column(1)],
                    names=["ordering", "key", "point", "query"])
    return run


def _place_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the number of their partition and their place in it."""
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, part, dtype=np.int32)), pa.array(np.arange(at, at + n))],
            names=[*batch.schema.names, "part", "place"])
        at += n


def _ranked(points: DataFrame, dim: int, orders: int, dims: int, bits: int, seed: int) -> DataFrame:
    """All orderings, one after the other: (ordering, point, query, rank)."""
    keyed = points.mapInArrow(_key_batches(dim, orders, dims, bits, seed),
                              "ordering int, key bigint, point bigint, query boolean")
    sorted_ = keyed.repartitionByRange("ordering", "key", "point").sortWithinPartitions("ordering", "key", "point")
    schema = T.StructType([*sorted_.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType())])
    placed = written(sorted_.mapInArrow(_place_batches, schema), "orderings")
    counts = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("part", before.alias("before"))
    return placed.join(starts, "part").select("ordering", "point", "query", (F.col("before") + F.col("place")).alias("rank"))


def _brute_batches(queries: np.ndarray, points: np.ndarray, k: int, dim: int):
    """The ``k`` nearest points of a few given queries, per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best_s = np.full((len(queries), k), -np.inf)
        best_p = np.full((len(queries), k), -1, dtype=np.int64)
        for batch in batches:
            vecs = _matrix(batch.column(1), dim)
            own = batch.column(0).to_numpy()
            scores = queries @ (vecs / np.linalg.norm(vecs, axis=1, keepdims=True)).T
            scores[points[:, None] == own[None, :]] = -np.inf
            s = np.concatenate([best_s, scores], axis=1)
            p = np.concatenate([best_p, np.broadcast_to(own, scores.shape)], axis=1)
            top = np.argsort(-s, axis=1, kind="stable")[:, :k]
            best_s, best_p = np.take_along_axis(s, top, 1), np.take_along_axis(p, top, 1)
        at = np.isfinite(best_s)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(points, k).reshape(-1, k)[at]), pa.array(best_p[at]), pa.array(best_s[at])],
                                         names=["q", "point", "score"])
    return run


def fitted_width(points: DataFrame, ranked: DataFrame, dim: int, k: int, sample: int, aim: float, margin: float) -> int:
    """Window width from the true neighbours of at most ``sample`` queries."""
    chosen = points.where("query").orderBy(F.xxhash64("point"), "point").limit(sample).select("point", "vec").toPandas()
    if chosen.empty:
        return LEAST_WIDTH
    vecs = np.array(chosen["vec"].tolist())
    near = points.select("point", "vec").mapInArrow(
        _brute_batches(vecs / np.linalg.norm(vecs, axis=1, keepdims=True), chosen["point"].to_numpy(), k, dim), "q bigint, point bigint, score double")
    true = near.withColumn("r", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "point"))).where(F.col("r") <= k).select("q", "point")
    true = F.broadcast(written(true, "true-neighbours"))  # at most sample * k rows
    at_query = ranked.join(F.broadcast(true.select("q").distinct()), F.col("point") == F.col("q"), "left_semi").select(
        F.col("ordering"), F.col("point").alias("q"), F.col("rank").alias("q_rank"))
    at_point = ranked.join(true, "point").select("ordering", "q", "point", "rank")
    gaps = (at_point.join(at_query, ["ordering", "q"]).groupBy("q", "point").agg(F.min(F.abs(F.col("rank") - F.col("q_rank"))).alias("gap"))
            .agg(F.percentile("gap", F.lit(aim)).alias("w")).first()["w"])
    return max(LEAST_WIDTH, int((gaps or 0) * margin) + 1)


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    # Scaled by the largest component, so squares neither overflow nor vanish.
    a, b = a / np.abs(a).max(axis=1, keepdims=True, initial=0), b / np.abs(b).max(axis=1, keepdims=True, initial=0)
    return np.clip((a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))), -1.0, 1.0)


def _unit(vecs: np.ndarray) -> np.ndarray:
    unit = vecs / np.abs(vecs).max(axis=1, keepdims=True)
    return (unit / np.linalg.norm(unit, axis=1, keepdims=True)).astype(np.float32)


def _best_of_block(q_point, q_vecs, first, last, point, vecs, unit, k: int):
    """(row of the query, place of the point, cosine): the ``k`` best points at
    ``first`` to ``last`` for each query; ties go to the smaller point."""
    dim = vecs.shape[1]
    # Rounding to single precision and summing err by less than this on each side.
    slack = np.float32(2 * (dim + 8) * 2.0 ** -24)
    lo, hi = int(first.min()), int(last.max()) + 1
    at = np.arange(lo, hi)
    score = _unit(q_vecs) @ unit[lo:hi].T
    score[(at < first[:, None]) | (at > last[:, None]) | (point[None, lo:hi] == q_point[:, None])] = -np.inf
    if hi - lo > k:
        limit = -np.partition(-score, k - 1, axis=1)[:, k - 1] - slack
    else:
        limit = np.full(len(q_point), -np.inf, dtype=np.float32)
    row, place = np.nonzero((score >= limit[:, None]) & (score > -np.inf))
    place += lo
    chunk = max(1, (1 << 21) // dim)
    exact = np.empty(len(row))
    for x in range(0, len(row), chunk):
        exact[x:x + chunk] = _cosines(q_vecs[row[x:x + chunk]], vecs[place[x:x + chunk]])
    order = np.lexsort((point[place], -exact, row))
    row, place, exact = row[order], place[order], exact[order]
    top = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[top], place[top], exact[top]


def _window_batches(size: int, dim: int, k: int):
    """Rows sorted by (block, asks, rank), the block's points before the queries that
    reach it, to the ``k`` best points of each query in each block. Held are one
    block's points; queries stream past them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, points = None, [], None

        def gathered():
            point = np.concatenate([p for p, _ in held])
            vecs = np.concatenate([v for _, v in held])
            return point, vecs, _unit(vecs)

        for batch in batches:
            rows = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("block", "asks", "first", "last", "point")}
            vecs = _matrix(batch.column("vec"), dim)
            kind = rows["block"] * 2 + rows["asks"]
            cuts = [0, *(np.flatnonzero(kind[1:] != kind[:-1]) + 1).tolist(), len(kind)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                if rows["block"][lo] != block:
                    block, held, points = int(rows["block"][lo]), [], None
                if not rows["asks"][lo]:
                    held.append((rows["point"][lo:hi], vecs[lo:hi]))
                    continue
                points = points or gathered()
                for x in range(lo, hi, _QUERIES):
                    y = min(hi, x + _QUERIES)
                    first = np.maximum(rows["first"][x:y] - block * size, 0)
                    last = np.minimum(rows["last"][x:y] - block * size, len(points[0]) - 1)
                    row, place, score = _best_of_block(rows["point"][x:y], vecs[x:y], first, last, *points, k)
                    yield pa.RecordBatch.from_arrays([pa.array(rows["point"][x:y][row]), pa.array(points[0][place]), pa.array(score)],
                                                     names=["q", "point", "score"])
    return run


def dealt_to_blocks(ranked: DataFrame, points: DataFrame, width: int, block_rows: int) -> DataFrame:
    """Each point in its block of ``block_rows`` ranks; each query, as another row, in
    every block that its window (ranks ``first`` to ``last``) reaches."""
    n = points.count()  # ranks of an ordering follow those of the one before
    first, last = F.greatest(F.col("rank") - width, F.col("ordering") * F.lit(n)), F.least(F.col("rank") + width, (F.col("ordering") + 1) * F.lit(n) - 1)
    with_vecs = ranked.select("point", "query", "rank", first.alias("first"), last.alias("last")).join(points.select("point", "vec"), "point")
    sides = F.array(F.lit(False), F.col("query"))
    return (with_vecs.withColumn("asks", F.explode(F.array_distinct(sides)))
            .withColumn("block", F.explode(F.when(F.col("asks"), F.sequence(F.floor(F.col("first") / block_rows), F.floor(F.col("last") / block_rows)))
                                            .otherwise(F.array(F.floor(F.col("rank") / block_rows)))))
            .select("block", "asks", "rank", "first", "last", "point", "vec"))


def _own_batches(dim: int):
    """Rows (q, point, vec) to the cosine of the vector with itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = _matrix(batch.column(2), dim)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(_cosines(vecs, vecs))], names=["q", "point", "score"])
    return run


def nearest(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5,
            orders: int = ORDERS, dims: int = DIMENSIONS, bits: int = BITS, seed: int = 5, sample: int = SAMPLE,
            aim: float = AIM, margin: float = MARGIN, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id is divisible by ``every``."""
    empty = df.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows, dim = valid_vectors(df, id_col, vector_col)
    if not dim:
        return empty
    bits = min(bits, 64 // min(dims, dim))
    # One id more than asked for: a query is not its own neighbour.
    points = written(distinct_points(rows, dim, k + 1), "points")
    asked = written(rows.where(F.col("id") % every == 0).select("id", "vec").distinct()
                    .join(points.select("vec", "point"), "vec").select(F.col("id").alias("query_id"), F.col("point").alias("q")), "queries")
    flagged = written(points.join(asked.select(F.col("q").alias("point")).distinct().withColumn("query", F.lit(True)), "point", "left")
                      .select("point", F.coalesce("query", F.lit(False)).alias("query"), "vec", "ids"), "points")
    ranked = _ranked(flagged.select("point", "query", "vec"), dim, orders, dims, bits, seed)
    width = fitted_width(flagged, ranked, dim, k, sample, aim, margin)
    dealt = dealt_to_blocks(ranked, flagged, width, block_rows)
    found = (dealt.repartition("block").sortWithinPartitions("block", "asks", "rank")
             .mapInArrow(_window_batches(block_rows, dim, k), "q bigint, point bigint, score double"))
    # A point is found in several orderings, each time with the same score.
    found = found.groupBy("q", "point").agg(F.max("score").alias("score"))
    near = found.withColumn("r", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "point"))).where(F.col("r") <= k).drop("r")
    # A query's own point brings the ids of equal vectors.
    own = flagged.where("query").select(F.col("point").alias("q"), "point", "vec").mapInArrow(_own_batches(dim), "q bigint, point bigint, score double")
    scored = near.union(own).join(flagged.select("point", "ids"), "point")
    best = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    top = (scored.select("q", F.explode("ids").alias("vec_id"), "score").withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r"))
    by_query = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asked.join(top, "q").where("vec_id <> query_id").withColumn("rank", F.row_number().over(by_query))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
