"""Mixing against DuckDB and plain Python."""

import math

import duckdb
import pytest

from kestrel.llm.mixing import mix, mixed_rows, sample_bounds, source_targets
from kestrel.llm.queries import ORACLES, op8_mixing

CHECK = "/root/testdata/sf0.01"


def test_whole_table_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{CHECK}/documents.parquet')")
    want = {r[0]: r for r in con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({ORACLES['op8_mixing']})").fetchall()}
    rows = op8_mixing(spark, CHECK).collect()
    assert len(rows) == len(want)
    for r in rows:
        w = want[r["doc_id"]]
        assert (r["size"], r["source_size"], r["taken"]) == (w[1], w[2], w[4])
        assert math.isclose(r["target"], w[3], rel_tol=1e-12)
        assert r["taken"] <= 2 * r["size"]


def filled(sizes, share, most, weights):
    """Water filling, one source at a time."""
    left, open_, got = share * sum(sizes), list(range(len(sizes))), {}
    while open_:
        level = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if weights[i] * level > most * sizes[i]]
        if not over:
            got |= {i: weights[i] * level for i in open_}
            break
        for i in over:
            got[i] = most * sizes[i]
            left -= got[i]
            open_.remove(i)
    return got


@pytest.mark.parametrize("sizes", [[100, 5, 400, 1, 90, 3000, 2], [7], [0, 10, 0], [0, 0], [10] * 12])
def test_targets(spark, sizes):
    rows = [(f"s{k:02d}" if k else None, s) for k, s in enumerate(sizes)]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or ""))
    weights = {k: (3.0, 1.0, 2.0)[place % 3] for place, k in enumerate(order)}
    got = {r["source"]: r["target"] for r in source_targets(spark.createDataFrame(rows, "source string, source_size bigint")).collect()}
    for k, want in filled(sizes, 1.5, 2.0, weights).items():
        assert math.isclose(got[rows[k][0]], want, rel_tol=1e-9, abs_tol=1e-9)


def test_bounds_are_nested_and_nearest(spark):
    rows = [("a", 1 + k % 7, (k * 2654435761 * 40503) % (1 << 60)) for k in range(500)] + [(None, 50, 12345)] * 3
    docs = spark.createDataFrame(rows, "source string, size bigint, h bigint")
    total, before = sum(r[1] for r in rows if r[0] == "a"), -1
    for extra in (0.0, 3.0, total / 3, total / 2, total - 1.0):
        found = {r["source"]: r["bound"] for r in sample_bounds(docs, spark.createDataFrame([("a", extra), (None, 80.0)], "source string, extra double")).collect()}
        taken = sum(s for src, s, h in rows if src == "a" and h < found["a"])
        assert abs(taken - extra) <= 3.5 and found["a"] >= before
        assert found[None] == 12346  # equal hashes go together: 150 is nearer to 80 than 0
        before = found["a"]


def test_copies_and_odd_rows(odd_docs, no_docs):
    plan = mix(odd_docs).collect()
    assert len(plan) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in plan}
    assert [by_id[i]["size"] for i in (4, 5, 6, 7, 8, 13)] == [0, 0, 0, 1, 4, 5]
    assert {tuple(r) for r in mix(odd_docs).collect()} == {tuple(r) for r in plan}  # reruns agree
    out = mixed_rows(odd_docs)
    assert out.columns == odd_docs.columns
    assert out.count() == sum(r["copies"] for r in plan)
    assert mix(no_docs).count() == 0 and mixed_rows(no_docs).count() == 0


def test_a_source_under_one_id_or_null_comes_near_its_target(spark):
    from kestrel.llm.mixing import mix, mixed_rows
    rows = [(k, f"w{k} b c d", "a") for k in range(1000)] + [(None, f"v{k} b c d", "b") for k in range(1000)] + [(7, "same four words here", "c")] * 1000
    rows += [(5, f"u{k} b c d", "d") for k in range(1000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    runs = []
    for parts in (2, 5):
        out = mix(df.repartition(parts)).collect()
        assert len(out) == 4000
        taken = {}
        for r in out:
            taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["copies"]
            assert 0 <= r["copies"] <= 2
        for source, target in {r["source"]: r["target"] for r in out}.items():
            assert abs(taken[source] - target) <= 4, source
        runs.append(sorted((r["source"], str(r["doc_id"]), r["copies"]) for r in out))
        mixed = [r["source"] for r in mixed_rows(df.repartition(parts)).collect()]
        assert {s: 4 * mixed.count(s) for s in "abcd"} == taken
    assert runs[0] == runs[1]
