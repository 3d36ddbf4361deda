"""SuperMinHash near-duplicates against exact similarity on full sets."""

import random
import re

import numpy as np
import pytest

from kestrel.llm import near_dedup
from kestrel.llm.components import components
from kestrel.llm.near_dedup import near_duplicates, one_of_each_group, superminhash
from kestrel.llm.queries import op3_near_dedup
from kestrel.llm.textblocks import mix64, seeded

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*[words[k:] for k in range(n)]))


class Groups:
    def __init__(self):
        self.up = {}

    def root(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


def brute(rows, n, percent=80):
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    groups = Groups()
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    groups.join(i, j)
    return {i: (len(a), groups.root(i)) for i, a in sets}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_whole_table_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert found(op3_near_dedup(spark, SMALL)) == brute(rows, 2)


@pytest.mark.parametrize("small,pivots", [(128, 64), (2, 1)])
def test_chains_hubs_and_mixed_buckets(spark, monkeypatch, small, pivots):
    """Chains in which only neighbours are similar, copies, and families that share
    much text; with large-bucket rules forced on small buckets too."""
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", small)
    rng = random.Random(3)
    rows, base = [], [f"w{k}" for k in range(60)]
    for step in range(12):  # each drops two words and adds two
        rows.append((500 - step, " ".join(base[step * 2:] + [f"n{k}" for k in range(step * 2)])))
    for k in range(40):
        words = [f"f{j}" for j in range(50)]
        for _ in range(rng.randrange(8)):
            words[rng.randrange(50)] = f"r{rng.randrange(1000)}"
        rows.append((k, " ".join(words)))
    rows += [(100, "same Text here"), (101, "SAME text HERE"), (102, "x"), (103, "X"), (104, ""), (105, None), (106, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert found(near_duplicates(df, shingle_words=2, pivots=pivots)) == brute(rows, 2)


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(60)] + [(200, rng.randrange(100, 200)) for _ in range(80)] + \
            [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)] + [(7, 7)]
    groups = Groups()
    for a, b in links:
        groups.join(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "x bigint, y bigint").repartition(5), "x", "y").collect()}
    assert got == {n: groups.root(n) for n in groups.up if groups.root(n) != n}
    assert components(spark.createDataFrame([], "x bigint, y bigint"), "x", "y").count() == 0


def test_signatures_match_an_element_by_element_walk():
    slots = 16
    sets = [seeded(n, 40 + n) for n in (1, 3, 40, 400)] + [np.empty(0, dtype=np.uint64)]
    limits = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    got = superminhash(np.concatenate(sets), limits, slots)
    salts = seeded(slots, 101)
    for s, sig in zip(sets, got):
        best = [np.iinfo(np.uint64).max] * slots
        for e in s:
            order = list(range(slots))
            for step in range(slots):
                x = int(mix64(np.array([e + salts[step]]))[0])
                pick = step + ((x >> 40) * (slots - step) >> 24)
                order[step], order[pick] = order[pick], order[step]
                best[order[step]] = min(best[order[step]], step << 40 | x & ((1 << 40) - 1))
        assert sig.tolist() == best


def test_signatures_estimate_similarity():
    a = seeded(1000, 1)
    for shared in (500, 800, 950):
        b = np.concatenate([a[:shared], seeded(1000 - shared, 2)])
        sig = superminhash(np.concatenate([a, b]), np.array([0, 1000, 2000]), 200)
        true = shared / (2000 - shared)
        assert abs((sig[0] == sig[1]).mean() - true) < 0.12


def test_odd_rows(odd_docs, no_docs):
    got = near_duplicates(odd_docs, shingle_words=5).collect()
    assert len(got) == odd_docs.count()
    by_id = {r["doc_id"]: (r["component_id"], r["kept"]) for r in got}
    assert by_id[2] == (1, False) and by_id[3] == (1, False) and by_id[12] == (1, False) and by_id[14] == (13, False)
    assert by_id[None] == (None, True)
    assert all(by_id[i] == (i, True) for i in (1, 4, 5, 6, 7, 8, 9, 10, 13))
    left = one_of_each_group(odd_docs, shingle_words=5)
    assert left.columns == odd_docs.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 7, 8, 9, 10, 11, 13, 15] and ids.count(None) == 1
    assert near_duplicates(no_docs).count() == 0 and one_of_each_group(no_docs).count() == 0


def test_one_id_on_several_texts_loses_no_text(spark):
    a = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    rows = [(1, a, "x"), (1, "a wholly different text under the same id that nobody else has", "y"), (1, a, "w"), (2, a + " sixteen", "z"),
            (2, "short", "q"), (3, None, "n"), (3, "", "n"), (None, a, "k"), (4, "alone but not empty", "r")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _gone string")
    runs = [sorted((r["doc_id"] or 0, r["text"] or "", r["_gone"]) for r in near_dedup.one_of_each_group(df.repartition(n), shingle_words=5, percent=80).collect()) for n in (1, 4)]
    assert runs[0] == runs[1]
    texts = [t for _, t, _ in runs[0]]
    assert "a wholly different text under the same id that nobody else has" in texts and "short" in texts and "alone but not empty" in texts
    assert sum(t.startswith("one two") for i, t, _ in runs[0] if i) == 1 and (0, a, "k") in runs[0]


def test_step_folders_go(spark):
    import os
    from kestrel.session import checkpoint_dir, local_path
    folder = local_path(checkpoint_dir(spark))
    before = set(os.listdir(folder))
    df = spark.createDataFrame([(k, f"some words in a row number {k % 3}") for k in range(20)], "doc_id bigint, text string")
    assert near_dedup.near_duplicates(df, shingle_words=2).where("kept").count() == 3
    left = {n for n in set(os.listdir(folder)) - before if n.startswith(("signatures", "nodes", "buckets", "sets", "pairs", "links", "mixed", "prints", "likely"))}
    assert left == set()


def test_prints_are_kept_of_likely_pairs_only(spark, monkeypatch):
    """They were written for every document, most of the scratch files."""
    seen = {}

    def spy(df, name, **options):
        out = written(df, name, **options)
        seen.setdefault(name, (out.columns, out.count()))
        return out

    from kestrel.llm import near_dedup as N
    written = N.written
    monkeypatch.setattr(N, "written", spy)
    alone = [(i, " ".join(f"w{i}x{j}" for j in range(60))) for i in range(40)]
    near = [(100 + i, " ".join(f"near{j}" for j in range(200 + i))) for i in range(2)]
    df = spark.createDataFrame([*alone, *near, (200, ""), (201, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(df).collect()}
    assert got == {**{i: i for i, _ in alone}, 100: 100, 101: 100, 200: 200, 201: 201}
    assert "prints" not in seen["signatures"][0]
    assert seen["prints"] == (["node", "prints"], 2)
