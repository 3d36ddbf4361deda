"""Substring dedup against brute force over all windows."""

import hashlib

import pytest

from kestrel.llm import phrase_dedup
from kestrel.llm.phrase_dedup import PhraseAutomaton, remove_repeats
from kestrel.llm.queries import op1_substring_dedup

SMALL = "/root/testdata/sf0.001"


def brute(rows, window):
    first, out = {}, {}
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = b" ".join(words[s: s + window])
            if first.setdefault(key, i) < i:
                gone[s: s + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def digest(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()}


def test_whole_table_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(rows, 50)
    assert digest(op1_substring_dedup(spark, SMALL)) == want
    assert sum(w[1] for w in want.values()) > 0


@pytest.mark.parametrize("window,anchor", [(8, 3), (5, 1)])
def test_short_windows_and_small_shards(spark, monkeypatch, window, anchor):
    """A common phrase amid different texts, overlaps of several documents and
    repeats inside one, with shards of few passages and segments."""
    monkeypatch.setattr(phrase_dedup, "PASSAGES_PER_SHARD", 3)
    monkeypatch.setattr(phrase_dedup, "SEGMENTS_PER_STREAM", 4)
    common = [f"c{k}" for k in range(window + 3)]
    rows = []
    for i in range(40):
        own = [f"w{i % 13}_{k}" for k in range(window)]
        rows.append((i, " ".join(own[: i % window] + common[: window - 2 + i % 5] + own)))
    rows += [(100, " ".join(["a"] * 30)), (101, " ".join(["a"] * 9)), (102, None), (103, "")]
    got = digest(remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), window=window, anchor=anchor))
    assert got == brute(rows, window)


def test_odd_rows(spark, odd_docs, no_docs):
    got = remove_repeats(odd_docs, keep_text=True).collect()
    assert len(got) == odd_docs.count()
    rows = {r["doc_id"]: r for r in got}
    want = brute([(i, t) for i, t in {(r["doc_id"], r["text"]) for r in odd_docs.collect()}], 50)
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in rows.items() if i is not None} == want
    assert rows[4]["kept_text"] == rows[5]["kept_text"] == ""
    assert rows[None]["n_removed"] == 0  # a null id neither removes nor loses
    assert remove_repeats(no_docs).count() == 0


def test_automaton_extends_and_reports_each_passage():
    a = PhraseAutomaton(6)
    words = [bytes([65 + k]) for k in range(12)]
    codes = "".join(chr(200 + k) for k in range(12))
    a.add(words, codes, 7)
    a.compile()
    text = [b"x"] + words[2:9] + [b"y"]
    coded = chr(9) + codes[2:9] + chr(10)
    assert list(a.matches(text, coded)) == [(1, 8, 7)]
    assert list(a.matches(words[3:8], codes[3:8])) == []


def test_a_phrase_amid_many_contexts_keeps_shards_small(spark, monkeypatch):
    """A 40-word phrase amid contexts that recur in pairs: all passages name one anchor,
    and their number grows with the table."""
    from pyspark.sql import functions as F
    limit = 50
    monkeypatch.setattr(phrase_dedup, "PASSAGES_PER_SHARD", limit)
    seen = []
    plain = phrase_dedup._sharded

    def kept(*args):
        seen.append(plain(*args).cache())
        return seen[-1]

    monkeypatch.setattr(phrase_dedup, "_sharded", kept)
    phrase = " ".join(f"p{k}" for k in range(40))
    rows = []
    for i in range(400):
        own = f"{i // 2}"
        rows.append((i, " ".join(f"a{own}x{k}" for k in range(30)) + " " + phrase + " " + " ".join(f"b{own}y{k}" for k in range(30 + i % 3))))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert digest(remove_repeats(df, keep_text=False)) == brute(rows, 50)
    per_anchor = seen[0].where("mask is not null").groupBy(F.split("shard", "[.]")[0].alias("a")).agg(F.count_distinct("sid_hi", "sid_lo").alias("n"))
    assert per_anchor.agg(F.max("n")).first()[0] > 3 * limit
    per_shard = seen[0].where("mask is not null").groupBy("shard").agg(F.sum(F.bit_count("mask")).alias("n"), F.count("*").alias("rows"))
    assert per_shard.agg(F.max("rows")).first()[0] <= 2 * limit
