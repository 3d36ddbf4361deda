"""Pipeline stages: each decides on its own input, and its decisions take effect."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from kestrel.llm.common import written
from kestrel.llm.mixing import mix

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage over the small table."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = written(stage(spark, docs, SMALL), f"test-{name}")
        out[name] = (docs, made)
        docs = made
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns_and_order(stages):
    assert list(stages) == ["language_id", "near_dedup", "secret_scan", "mixing", "packing"]
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_stage_keeps_texts_with_letters(stages):
    before, after = map(rows, stages["language_id"])
    assert set(after) == {i for i, r in before.items() if any(c.isalpha() for c in r["text"] or "")}
    assert all(after[i] == before[i] for i in after)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(zip(*[words[k:] for k in range(5)])) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def test_near_dedup_stage_keeps_one_of_each_group(stages):
    before, after = map(rows, stages["near_dedup"])
    sets, group = {i: shingles(r["text"]) for i, r in before.items()}, {i: i for i in before}
    changed = True
    while changed:
        changed = False
        for i, a in sets.items():
            for j, b in sets.items():
                if a and b and group[i] > group[j] and 100 * len(a & b) >= 80 * len(a | b):
                    group[i], changed = group[j], True
    assert set(after) == set(group.values())
    assert len(after) < len(before) and all(after[i] == before[i] for i in after)


def test_secrets_are_replaced_and_nothing_else(stages):
    before, after = map(rows, stages["secret_scan"])
    assert set(before) == set(after)
    for i, r in after.items():
        assert not re.search("[0-9a-f]{24}|AKIA[A-Z0-9]{16}", r["text"])
        if "[secret]" in r["text"]:
            assert r["n_chars"] == len(r["text"])
            pieces = [re.escape(p) for p in r["text"].split("[secret]")]
            assert re.fullmatch("(?s).+?".join(pieces), before[i]["text"])
        else:
            assert r == before[i]


def test_mixing_stage_repeats_and_drops(stages):
    docs, made = stages["mixing"]
    want = {r["doc_id"]: r["copies"] for r in mix(docs).collect()}
    assert Counter(r["doc_id"] for r in made.collect()) == Counter({i: c for i, c in want.items() if c})


def test_packing_stage_takes_every_row(stages):
    docs, made = stages["packing"]
    firsts = Counter(r["doc_id"] for r in made.where("piece = 0").collect())
    assert firsts == Counter(r["doc_id"] for r in docs.collect())
    assert all(r["s"] <= 2048 for r in made.groupBy("sequence_id").sum("length").withColumnRenamed("sum(length)", "s").collect())


def test_run_applies_the_stages(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SMALL).select(columns).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, stages["packing"][1].select(columns).collect()))


def test_odd_rows_go_through_all_stages(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            made = written(stage(spark, docs, SMALL), f"test-odd-{name}")
            if name != "packing":
                assert made.columns == odd_docs.columns
            docs = made
        assert (docs.count() == 0) == (made.count() == 0)
