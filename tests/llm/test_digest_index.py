"""Digest index: batches, appends, replays, buckets, hot texts, odd rows."""

import hashlib
from collections import defaultdict

from kestrel.llm import digest_index as D
from kestrel.llm.queries import op13_exact_dedup
from kestrel.session import scratch_path


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def new_index(spark, **options):
    return D.DigestIndex.create(spark, scratch_path(spark, "test-index"), **options)


def plain(rows):
    """(id, keep_id, group_size, digest) per row, and the texts' kept counts."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256(low(t).encode()).hexdigest()].append(i)
    most = lambda ids: max((i for i in ids if i is not None), default=None)
    return [(i, most(ids), len(ids), d) for d, ids in groups.items() for i in ids]


def as_tuples(rows):
    return [(r["id"], r["keep_id"], r["group_size"], r["digest"].hex()) for r in rows]


def key(t):
    return tuple((x is not None, x) for x in t)


def test_batches_of_falling_ids_agree_with_one(spark, monkeypatch):
    rows = [(k, ["same text", "SAME text", "same  text", "other", "ÄB", "äb", None, "", f"text {k}"][k % 9]) for k in range(500)]
    rows += [(1000 + k, "hot") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    monkeypatch.setattr(D, "HOT_SHARE", 20)
    for batches in (1, 4):
        index = new_index(spark)
        out = D.ingested(df, index, batches=batches).collect()
        assert sorted(as_tuples(out), key=key) == sorted(plain(rows), key=key)
        assert all(r["kept"] == (r["id"] == r["keep_id"]) for r in out)
        assert index.entries().count() == len({low(t) for _, t in rows})


def test_later_batches_meet_the_index(spark):
    index = new_index(spark)
    one = spark.createDataFrame([(5, "a"), (7, "A"), (8, "b")], "doc_id bigint, text string")
    two = spark.createDataFrame([(99, "B"), (98, "c"), (97, "C")], "doc_id bigint, text string")
    kept = lambda df, index: sorted(tuple(r) for r in D.deduplicated(df, index).collect())
    assert kept(one, index) == [(7, "A"), (8, "b")]
    assert kept(two, index) == [(98, "c")]
    assert kept(two, index) == [(98, "c")]  # given again after a failure
    again = D.DigestIndex.open(spark, index.path)
    assert kept(one, again) == [(7, "A"), (8, "b")]
    assert again.entries().count() == 3
    small = again.compacted(scratch_path(spark, "test-index"))
    assert sorted(r["keep_id"] for r in small.entries().collect()) == [7, 8, 98]


def test_index_side_is_merged_without_a_shuffle(spark):
    index = new_index(spark)
    groups = D.written(D.digested(spark.createDataFrame([(1, "x")], "doc_id bigint, text string")).groupBy("digest").count(), "test-groups")
    plan = index.fresh(groups)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning(digest") == 1  # the groups go to the buckets, the index stays
    assert "Python" not in plan


def test_rows_that_repeat_an_id_leave_one(spark):
    rows = [(1, "t", "x"), (1, "t", "y"), (1, "t", "x"), (1, "T", "z"), (None, "t", "n"), (None, "u", "n"), (None, "u", "n"), (2, None, "e"), (2, "", "e")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, extra string")
    decided = D.ingested(df, new_index(spark)).collect()
    assert sorted(as_tuples(decided), key=key) == sorted(plain([r[:2] for r in rows]), key=key)
    assert sum(r["kept"] for r in decided) == 3
    texts = lambda parts: sorted(tuple(r) for r in D.deduplicated(df.repartition(parts), new_index(spark)).na.fill({"doc_id": -1, "text": ""}).collect())
    assert texts(1) == texts(4) and len(texts(2)) == 3


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    out = D.ingested(odd_docs, new_index(spark), batches=3).collect()
    assert sorted(as_tuples(out), key=key) == sorted(plain(rows), key=key)
    clean = D.deduplicated(odd_docs, new_index(spark))
    assert clean.columns == odd_docs.columns
    assert sorted(low(r["text"]) for r in clean.collect()) == sorted({low(t) for _, t in rows})
    assert D.ingested(no_docs, new_index(spark), batches=3).count() == 0
    assert D.deduplicated(no_docs, new_index(spark)).count() == 0


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows = op13_exact_dedup(spark, "/root/testdata/sf0.001").collect()
    assert sorted(tuple(r) for r in rows) == sorted((i, k, n, i == k, d) for i, k, n, d in plain(docs))
