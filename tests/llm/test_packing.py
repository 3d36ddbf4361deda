"""Packing: ids against the tokenizer, pieces, capacities, odd rows."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from kestrel.llm.common import tokenizer_paths
from kestrel.llm.packing import Capacity, ChunkEncoder, pack, vector_best_fit
from kestrel.llm.queries import op10_packing
from kestrel.llm.textblocks import byte_blocks

SMALL = "/root/testdata/sf0.001"
TRICKY = ["a <|endoftext|> b", "  x\n\ny   z w", "don't I'll　 a", "à la carte é", "a\x1c b", "x \u0085y", "tab\tq  r\n s", "", None,
          "中文 字 a", "x " * 3000, "l'été où ça naïve", "A  b  c", "  q  ", "ends ", " starts", "﻿ x", "é <|endoftext|>é", "1 2\n3"]


def plain_ids(texts):
    tokenizer = Tokenizer.from_file(tokenizer_paths()["tokenizer"])
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("ranks", [True, False])
def test_chunks_give_the_tokenizers_ids(spark, ranks):
    texts = TRICKY + [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    paths = tokenizer_paths()
    encoder, got = ChunkEncoder(paths["tokenizer"], paths["ranks"] if ranks else None), []
    for _, data, offs in byte_blocks(pa.array(texts), 5000):
        ids, limits = encoder.encode(data, offs)
        got += [ids[a:b].tolist() for a, b in zip(limits[:-1], limits[1:])]
    assert got == plain_ids(texts)


def checked(rows, docs, sequence=2048):
    """Pieces and places of a result, against the ids."""
    ids = {i: np.array([*x, 0], dtype="<u4") for i, x in zip(docs, plain_ids(docs.values()))}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for i, pieces in by_doc.items():
        pieces.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        at = 0
        for r in pieces:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[i][at: at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids[i]) and all(r["length"] == sequence for r in pieces[1:]) and pieces[0]["length"] <= sequence
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= sequence
    return len(by_sequence), math.ceil(sum(map(len, ids.values())) / sequence)


def test_whole_table(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    used, least = checked(op10_packing(spark, SMALL).collect(), docs)
    assert used <= least + 2


@pytest.mark.parametrize("choice", ["norm", "dot"])
def test_every_capacity_holds(choice):
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 100, 600)
    for capacity in (Capacity(100, 100, 10_000, choice=choice), Capacity(100, 3, 10_000, choice=choice), Capacity(100, 100, 6_500, choice=choice)):
        usable = lengths[lengths ** 2 <= capacity.cost]
        bins, offset = vector_best_fit(usable, capacity)
        for b in range(bins.max() + 1):
            own = np.flatnonzero(bins == b)
            own = own[np.argsort(offset[own])]
            assert len(own) <= capacity.documents and (usable[own] ** 2).sum() <= capacity.cost
            assert offset[own].tolist() == np.concatenate([[0], np.cumsum(usable[own])[:-1]]).tolist()
            assert usable[own].sum() <= capacity.tokens
    short = lengths[lengths < 40]  # longer ones can't fill bins of 100 in pairs
    bins, _ = vector_best_fit(short, Capacity(100, 100, 10_000, choice=choice))
    assert bins.max() + 1 <= math.ceil(short.sum() / 100) + 2


def test_exact_fits_are_found():
    bins, _ = vector_best_fit(np.array([60, 40, 70, 30, 50, 50, 100]), Capacity(100, 10, 10_000))
    assert bins.max() + 1 == 4


def test_groups_and_odd_rows(odd_docs, no_docs):
    first = {}
    for r in odd_docs.collect():
        first.setdefault(r["doc_id"], r["text"])
    unique = odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = pack(unique, **tokenizer_paths(), group_pieces=4).collect()
    checked(rows, {i: t for i, t in first.items() if i is not None})
    all_rows = pack(odd_docs, **tokenizer_paths()).collect()
    assert sum(r["doc_id"] == 7 for r in all_rows) == 3 and sum(r["doc_id"] is None for r in all_rows) == 1
    assert [(r["length"], r["start"]) for r in all_rows if r["doc_id"] == 4] == [(1, 0)]
    assert pack(no_docs, **tokenizer_paths()).count() == 0
    with pytest.raises(ValueError):
        pack(odd_docs, **tokenizer_paths(), capacity=Capacity(cost=10))


def test_rows_that_repeat_a_document_spread_over_groups(spark):
    from kestrel.llm.common import tokenizer_paths
    df = spark.createDataFrame([(1, "the same short text")] * 3000 + [(k, f"text number {k}") for k in range(2, 300)], "doc_id bigint, text string")
    out = pack(df, **tokenizer_paths(), group_pieces=200).collect()
    assert len(out) == 3298
    per_group = {}
    for r in out:
        if r["doc_id"] == 1:
            per_group[r["sequence_id"] >> 32] = per_group.get(r["sequence_id"] >> 32, 0) + 1
    assert len(per_group) >= 15 and max(per_group.values()) < 400
