"""Two-pass external shuffle: counts, slots, seeds, files, odd rows."""

import zlib

import pytest

from kestrel.llm.external_shuffle import shuffled_shards, write_shards
from kestrel.llm.queries import op9_sharding

CHECK = "/root/testdata/sf0.01"


def slots(rows):
    out = {}
    for r in rows:
        out.setdefault(r["shard"], []).append(r["slot"])
    return {k: sorted(v) for k, v in out.items()}


def test_whole_table(spark):
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{CHECK}/documents.parquet").collect()}
    rows = op9_sharding(spark, CHECK).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        assert (r["size"], r["text_crc32"]) == (len(docs[r["doc_id"]]) + 1, zlib.crc32(docs[r["doc_id"]]))
        assert r["law"] == "rows" and r["grown_shard"] is None
    placed = slots(rows)
    assert set(placed) == set(range(8)) and all(v == list(range(len(v))) for v in placed.values())
    assert max(map(len, placed.values())) - min(map(len, placed.values())) <= 1


@pytest.mark.parametrize("n,shards,bucket_bytes", [(103, 8, 200), (103, 8, 1 << 20), (5, 8, 50), (64, 1, 300)])
def test_order_is_seeded_and_mixed(spark, n, shards, bucket_bytes):
    df = spark.createDataFrame([(k, "x" * (k % 50)) for k in range(n)], "doc_id bigint, text string")
    order = lambda seed, parts: [r["doc_id"] for r in shuffled_shards(
        df.repartition(parts), shards, seed=seed, bucket_bytes=bucket_bytes).orderBy("shard", "slot").collect()]
    one = order(1, 3)
    assert sorted(one) == list(range(n))
    assert order(1, 7) == one  # whatever the partitions of the input
    if n > 50:
        assert order(2, 3) != one and one != list(range(n))
        late = sum(k >= n // 2 for k in one[: n // 2])
        assert n // 8 < late < 3 * n // 8 + n // 16


def test_files_hold_whole_records(spark, tmp_path):
    df = spark.createDataFrame([(k, f"text {k}", k * 2) for k in range(50)], "doc_id bigint, text string, extra int")
    write_shards(df, f"file://{tmp_path}/out", 4, bucket_bytes=100)
    back = spark.read.parquet(f"file://{tmp_path}/out").collect()
    assert sorted((r["doc_id"], r["text"], r["extra"]) for r in back) == [(k, f"text {k}", k * 2) for k in range(50)]
    assert all(v == list(range(len(v))) for v in slots(back).values())


def test_odd_rows(odd_docs, no_docs):
    out = shuffled_shards(odd_docs, 4, bucket_bytes=5000)
    assert set(out.columns) == set(odd_docs.columns)  # shard and slot are replaced
    rows = out.collect()
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in rows) == sorted((r["doc_id"] or -1, r["text"] or "") for r in odd_docs.collect())
    assert all(v == list(range(len(v))) for v in slots(rows).values())
    assert shuffled_shards(no_docs, 4).count() == 0


def test_repeated_ids_and_rows_spread_over_buckets(spark):
    rows = [(k, f"text {k}") for k in range(600)] + [(7, f"seven {k}") for k in range(600)] + [(None, f"null {k}") for k in range(600)] + [(8, "same")] * 4500
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    order = lambda parts: [tuple(r) for r in shuffled_shards(
        df.repartition(parts), 4, bucket_bytes=3000).orderBy("shard", "slot").select("doc_id", "text").collect()]
    one = order(3)
    assert sorted(one, key=str) == sorted(rows, key=str)
    assert order(5) == one
    half = one[: len(one) // 2]
    for kind in ("seven", "null", "text"):
        assert 200 < sum(t.startswith(kind) for _, t in half) < 400, kind
    assert 2000 < sum(t == "same" for _, t in half) < 2500
