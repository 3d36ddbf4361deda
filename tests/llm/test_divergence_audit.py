"""Divergence audit: sparse merges against dense plain versions, shares, odd rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from kestrel.llm import divergence_audit as D
from kestrel.llm.queries import op11_divergence_audit
from kestrel.llm.textblocks import byte_blocks


def plain(rows, least_docs):
    """Both reports from (text, lang, source) rows, with Python's whole numbers."""
    counts, docs, lang_counts = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    groups = defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        terms = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        lang_counts[lang].update(terms)
        docs[lang].update(terms.keys())
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[k] for k in kept) + 2 * len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        own, q = {s: share(counts[lang, s]) for s in sources}, share(lang_counts[lang])
        for s in sources:
            pairs = [(sum(f(own[s][t], own[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(own[s][t], q[t]), t) for t in kept if counts[lang, s][t] and own[s][t] > q[t]]
            for part, items, top in (("pair", pairs, None), ("term", terms, 10)):
                ordered = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:top]
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ordered)]
    return sorted(out)


def reports(df, block_sources=8, **options):
    audit = D.Audit(df, **options)
    pick = lambda rows, part: [(r["lang"], r["source"], part, r["item"], r["value"], r["rank"]) for r in rows.collect()]
    return sorted(pick(audit.pair_divergence(block_sources), "pair") + pick(audit.term_divergence(), "term"))


@pytest.mark.parametrize("block_sources,slice_rows", [(8, 200_000), (2, 5)])
def test_equals_dense_version(spark, block_sources, slice_rows):
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("alpha", "BETA", "gämma", "漢", "z") for b in ("x", "Y", "ü", "")]
    rows = []
    for k in range(400):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice([None, "", "a", "b", "c", "d", "e", "ß"])
        rows.append((rng.choice([" ", ", ", "1", "_"]).join(rng.choices(words, k=rng.randint(0, 12))), lang, source))
    rows += [("", "en", "silent"), (None, "fr", "a"), ("one lone text", "fr", "b"), ("word " * 50, "it", "only")]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert reports(df, block_sources, least_docs=10, slice_rows=slice_rows) == plain(rows, 10)


def test_galloping_finds_what_a_set_finds():
    rng = np.random.default_rng(5)
    for n, m, top in [(0, 5, 9), (1, 1, 2), (3, 5000, 6000), (5000, 4000, 9000), (700, 90000, 10**6), (300, 300, 301)]:
        a, b = (np.sort(rng.choice(top, min(k, top), replace=False)) for k in (n, m))
        in_a, in_b = D.galloped(a, b)
        assert (a[in_a] == b[in_b]).all() and set(a[in_a].tolist()) == set(a.tolist()) & set(b.tolist())


def test_shares_are_exact_far_beyond_a_64_bit_product(spark):
    cases = [(0, 0, 1), (1, 1, 1), (10**12, 10**13, 10**7), (8 * 10**15, 8 * 10**15, 4), (123456789012, 987654321098765, 31)]
    df = spark.createDataFrame(cases, "n bigint, total bigint, v bigint")
    from pyspark.sql import functions as F
    got = [r["p"] for r in df.select(D.share(F.col("n"), F.col("total"), F.col("v")).alias("p")).collect()]
    want = [1 + 10**9 * (n + 2) // (t + 2 * v) for n, t, v in cases]
    assert got == want == [int(D.shares(np.array([n]), t, v)[0]) for n, t, v in cases]


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = (b"some words, " * 50 + b"x" * 300 + "é".encode() * 40 + b" 12 end ") * 3
    whole = [t for part in D.terms_of(text) for t in part]
    for piece in (1, 7, 100):
        monkeypatch.setattr(D, "PIECE", piece)
        assert [t for part in D.terms_of(text) for t in part] == whole
    assert whole.count(b"words") == 150 and whole.count(b"x" * 300 + "é".encode() * 40) == 3


def test_small_flushes_add_up(spark, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(D, "FLUSH", 1)
    monkeypatch.setattr(D, "byte_blocks", lambda c: byte_blocks(c, 4))
    batch = pa.record_batch({"lang": ["en"] * 4, "source": ["a", "a", "b", "a"], "text": ["x y x", "X", "z", None]})
    out = pa.Table.from_batches(D._count_batches([batch])).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    assert sorted(tuple(r.values()) for r in out.to_pylist()) == [("en", "a", "x", 3, 2), ("en", "a", "y", 1, 1), ("en", "b", "z", 1, 1)]


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["text"], r["lang"], r["source"]) for r in odd_docs.collect()]
    assert reports(odd_docs, least_docs=1) == plain(rows, 1)
    assert reports(odd_docs) == plain(rows, 10)  # no term is in ten documents
    assert reports(no_docs) == []


def test_hot_source_and_whole_table(spark):
    rows = [(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in op11_divergence_audit(spark, "/root/testdata/sf0.001").collect()]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert sorted(rows) == plain([(r["text"], r["lang"], r["source"]) for r in docs.collect()], 10)
