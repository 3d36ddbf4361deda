"""Hilbert curves and nearest vectors against brute force."""

import numpy as np

from kestrel.llm.hilbert import hilbert_keys
from kestrel.llm.queries import op5_nearest_vectors
from kestrel.llm.vector_search import nearest

CHECK = "/root/testdata/sf0.01"


def test_curve_visits_each_cell_by_single_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = hilbert_keys(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        assert set(np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1).tolist()) == {1}


def truth(rows, every, k):
    ids = np.array([i for i, _ in rows])
    unit = np.array([v for _, v in rows], dtype=np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    out = {}
    for j in np.flatnonzero(ids % every == 0):
        s = np.round(unit @ unit[j], 12)
        order = [x for x in np.lexsort((ids, -s)) if x != j][:k]
        out[int(ids[j])] = [(int(ids[x]), float(s[x])) for x in order]
    return out


def test_recall_on_the_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{CHECK}/embeddings.parquet").collect()]
    want, got = truth(rows, 50, 5), {}
    for r in op5_nearest_vectors(spark, CHECK).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    for q in want:
        for i, s in got[q]:
            a, b = (np.array(dict(rows)[x], dtype=np.float64) for x in (q, i))
            assert abs(s - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_small_blocks_and_partitions_still_see_whole_windows(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((30, 16))
    rows = [(i, (centres[i % 30] + 0.3 * rng.standard_normal(16)).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    want, got = truth(rows, 50, 5), {}
    for r in nearest(df, orders=12, block_rows=100).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sum(len(got[q] & {i for i, _ in want[q]}) for q in want) >= 0.9 * 5 * len(want)


def test_ties_copies_and_odd_vectors(spark):
    same = [1.0, 0.0, 0.0]
    rows = [(i, same) for i in range(0, 400)] + [(1000, [0.5, 0.5, 0.0]), (1001, [0.0, 1.0, 0.0]), (1050, [0.0, -1.0, 0.0]),
            (1100, None), (1150, [0.0, 0.0, 0.0]), (1200, [float("nan"), 1.0, 0.0]), (1250, [1.0, None, 0.0]),
            (1300, [float("inf"), 0.0, 0.0]), (1350, [1.0, 2.0]), (None, [0.1, 0.2, 0.3]), (50, same), (2, [1.0, -0.0, 0.0])]
    df = spark.createDataFrame([(*r, "x", 9) for r in rows], "vec_id bigint, embedding array<double>, rank string, score int").repartition(4)
    got = {}
    for r in nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 9)))
    assert set(got) == {*range(0, 400, 50), 1000, 1050}
    assert got[0] == [(k, k, 1.0) for k in range(1, 6)]
    assert got[100] == [(k + 1, k, 1.0) for k in range(5)]
    assert got[1000][:5] == [(k + 1, k, round(0.5 ** 0.5, 9)) for k in range(5)]
    assert nearest(df.where("vec_id is null")).count() == 0
    two = nearest(df.where("vec_id in (1000, 1001)")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in two] == [(1000, 1, 1001)]


def test_near_copies_keep_their_true_neighbours(spark):
    rng = np.random.default_rng(11)
    rows, groups = [], {}
    for size, spread in ((50, 0.04), (300, 0.04), (2000, 0.04), (300, 0.015), (50, 1e-3)):
        centre = rng.standard_normal(64)
        for _ in range(size):
            groups[len(rows)] = (size, spread)
            rows.append((len(rows), (centre + spread * rng.standard_normal(64)).tolist()))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    want, hits, asked = truth(rows, 10, 5), {}, {}
    for r in nearest(df, every=10).collect():
        g = groups[r["query_id"]]
        hits[g] = hits.get(g, 0) + (r["vec_id"] in {i for i, _ in want[r["query_id"]]})
    for q in want:
        asked[groups[q]] = asked.get(groups[q], 0) + 5
    recall = {g: hits.get(g, 0) / asked[g] for g in asked}
    assert min(recall.values()) >= 0.9, recall


def test_blocks_hold_no_more_than_their_rows_however_wide_the_windows(spark):
    from kestrel.llm.vector_search import dealt_to_blocks
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    ranked = spark.range(1200).selectExpr("cast(id div 600 as int) as ordering", "id % 600 as point", "id % 60 = 0 as query", "id as rank")
    dealt = dealt_to_blocks(ranked, df.selectExpr("vec_id as point", "embedding as vec"), 500, 64)
    held = dealt.where("not asks").groupBy("block").count().agg({"count": "max"}).first()[0]
    assert held == 64 and dealt.where("not asks").count() == 1200
    reached = {(r["rank"], r["block"]) for r in dealt.where("asks").collect()}
    assert reached == {(q, b) for q in range(0, 1200, 60) for b in range(19)
                       if max(q - 500, q // 600 * 600) <= b * 64 + 63 and b * 64 <= min(q + 500, q // 600 * 600 + 599)}
    # Windows as wide as the table give exactly the true neighbours.
    got = {}
    for r in nearest(df, orders=2, margin=1000.0, block_rows=64).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {q: [i for i, _ in found] for q, found in truth(rows, 50, 5).items()}
