"""Language identification: held-out accuracy, a plain version, odd rows."""

from collections import Counter

from kestrel.llm.common import held_out
from kestrel.llm.language_id import UNDETERMINED, identify, learn_profiles
from kestrel.llm.queries import op2_language_id

SMALL, CHECK = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def grams(text):
    """n-grams of one to three letters of a text, word limits as blanks."""
    runs, out = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text).split(), Counter()
    for i, w in enumerate(runs):
        out.update(w)
        p = f" {w} "
        out.update(p[k: k + 2] for k in range(len(p) - 1))
        out.update(p[k: k + 3] for k in range(len(p) - 2))
    return out


def key(g):
    """The order among equally frequent n-grams."""
    n = [0 if c == " " else ord(c) for c in g]
    if len(n) == 1:
        return (1 << 63) | n[0] << 42
    return (1 << 63) | n[0] << 21 | n[1] if len(n) == 2 else n[0] << 42 | n[1] << 21 | n[2]


def ranked(counts, size):
    return sorted(counts, key=lambda g: (-counts[g], key(g)))[:size]


def test_matches_a_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.withColumn("out", held_out()).collect()
    sums = {}
    for r in rows:
        if not r["out"] and r["lang"] is not None:
            sums.setdefault(r["lang"], Counter()).update(grams(r["text"]))
    size = 300
    profiles = {lang: {g: k for k, g in enumerate(ranked(c, size))} for lang, c in sums.items()}
    got = {r["doc_id"]: r for r in op2_language_id(spark, SMALL).collect()}
    assert len(got) == len(rows)
    for r in rows:
        own = ranked(grams(r["text"]), size)
        far = {lang: sum(abs(k - p[g]) if g in p else size for k, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        assert got[r["doc_id"]]["lang_pred"] == best
        assert abs(got[r["doc_id"]]["score"] - (1 - far[best] / (size * len(own)))) < 1e-9


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{CHECK}/documents.parquet").select("doc_id", "lang")
    joined = op2_language_id(spark, CHECK).where("held_out").join(docs, "doc_id").where("lang is not null").collect()
    assert len(joined) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in joined) >= 0.97 * len(joined)


def test_odd_rows(odd_docs, no_docs):
    profiles = learn_profiles(odd_docs)
    rows = identify(odd_docs, profiles).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[i]["lang_pred"] == UNDETERMINED and by_id[i]["score"] == 0.0 for i in (4, 5, 6, 8))
    assert all(0.0 <= r["score"] <= 1.0 and r["lang_pred"] in ("en", "de", UNDETERMINED) for r in rows)
    assert rows[0]["kept"] == "yes"  # other columns pass through
    nothing = learn_profiles(no_docs)
    assert identify(no_docs, profiles).count() == 0
    assert {r["lang_pred"] for r in identify(odd_docs, nothing).collect()} == {UNDETERMINED}
