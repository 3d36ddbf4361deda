"""Boundary sets against a sorted list; the transformation against a plain version."""

import hashlib
import re

import numpy as np
import pytest

from kestrel.llm import boundary_set as B
from kestrel.llm.fill_in_middle import fill_in_middle, restored
from kestrel.llm.queries import op12_fill_in_middle


@pytest.mark.parametrize("positions,kinds", [
    ([], []),
    ([0], ["ArrayContainer"]),
    (list(range(100)), ["RunContainer"]),
    (list(range(0, 3000, 7)), ["ArrayContainer"]),
    (list(range(0, 65536, 3)), ["BitmapContainer"]),
    (list(range(65536)), ["RunContainer"]),
    (list(range(10, 65536, 3)) + list(range(65536, 131072)) + [200000, 200002, 2**32 - 1],
     ["BitmapContainer", "RunContainer", "ArrayContainer", "ArrayContainer"]),
    ([65535, 65536], ["ArrayContainer", "ArrayContainer"]),
])
def test_select_is_the_sorted_list(positions, kinds):
    got = B.BoundarySet(np.array(positions, dtype=np.int64))
    assert [type(c).__name__ for c in got.containers] == kinds
    assert len(got) == len(positions)
    ranks = range(len(positions)) if len(positions) < 5000 else [*range(0, len(positions), 97), len(positions) - 1]
    assert [got.select(k) for k in ranks] == [positions[k] for k in ranks]
    with pytest.raises(IndexError):
        got.select(len(positions))


def plain(doc_id, text, percent=90, spm=20, seed=1):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k: 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def checked(df, **options):
    rows = fill_in_middle(df, **options)
    rows = rows.withColumn("back", restored(rows["output"], rows["form"])).collect()
    for r in rows:
        assert (r["n_units"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain(r["doc_id"], r["text"], *options.values())
        assert r["back"] == (r["text"] or "")
    return rows


def test_texts_with_near_marks_and_wide_characters(spark):
    texts = ["<P", "<S", "a<P>b", "<<S>", "<M", "P>", "<<<<", "<P<S<M", "é<漢 x>", "𝒳𝒴 a", "é", "\x00a\x00", "a\r\nb", "abcXYZ", "ÀB", "<M>"]
    rows = [(k, texts[k % len(texts)]) for k in range(len(texts) * 12)] + [(9000, "word, " * 90000), (9001, "é" * 70000), (9002, "ab1" * 60000)]
    forms = {r["form"] for r in checked(spark.createDataFrame(rows, "doc_id bigint, text string"))}
    assert forms == {"plain", "psm", "spm"}


def test_shares_and_seed_are_parameters(spark):
    df = spark.createDataFrame([(k, f"some words {k}") for k in range(200)], "doc_id bigint, text string")
    assert {r["form"] for r in checked(df, percent=100, spm_percent=100, seed=5)} == {"spm"}
    assert {r["form"] for r in checked(df, percent=0)} == {"plain"}


def test_odd_rows(odd_docs, no_docs):
    assert len(checked(odd_docs)) == odd_docs.count()
    clash = odd_docs.withColumn("output", odd_docs["doc_id"]).withColumn("_draws", odd_docs["lang"]).withColumn("form", odd_docs["size"])
    rows = checked(clash)
    assert {r["_draws"] for r in rows} == {r["lang"] for r in rows}
    assert fill_in_middle(no_docs).count() == 0


def test_whole_table(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    rows = op12_fill_in_middle(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        n, form, pre, mid, output = plain(r["doc_id"], docs[r["doc_id"]])
        assert tuple(r)[1:] == (n, form, pre, mid, sha(output), sha(docs[r["doc_id"]] or ""))
