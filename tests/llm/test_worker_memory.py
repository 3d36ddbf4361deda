"""What the Python stages of the pipeline hold and give back."""

import tracemalloc

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from kestrel.llm import common as C
from kestrel.llm import language_id as L
from kestrel.llm import packing as P
from kestrel.llm.textblocks import Roller


def _texts(n: int) -> pa.Array:
    rng = np.random.default_rng(3)
    words = ["".join(map(chr, rng.integers(97, 123, k))) for k in rng.integers(2, 9, 3000)]
    return pa.array([" ".join(words[i] for i in rng.integers(0, 3000, 400)) for _ in range(n)])


def _peak(run, batch) -> tuple[list, float]:
    """All results, and the MB held at most while they are made."""
    list(run(iter([batch.slice(0, 1)])))
    tracemalloc.start()
    try:
        out = list(run(iter([batch])))
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_language_stage_holds_small_blocks():
    """A block of 2 MB took over 100 MB of n-grams."""
    texts = _texts(1200)
    batch = pa.RecordBatch.from_arrays([texts, pa.array(["xx"] * len(texts))], names=["text", "lang"])
    assert texts.nbytes > 2 << 20
    assert _peak(L._count_batches, batch)[1] < 60


def test_packing_holds_small_blocks(monkeypatch):
    """The tables of the chunk hash and the arrays of a block of 2 MB took over 100 MB."""
    monkeypatch.setattr(P, "_CHUNK_HASH", Roller(71))
    texts = _texts(1200)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], names=["doc_id", "text"])
    run = P._piece_batches(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), 2048, 0)
    out, most = _peak(run, batch)
    assert most < 60
    monkeypatch.setattr(P, "_BLOCK", 2 << 20)
    assert out == list(run(iter([batch])))


def test_memory_is_given_back_after_the_last_batch(monkeypatch):
    gone = []
    monkeypatch.setattr(C, "_give_back", lambda: gone.append(1))
    assert list(C.lean(lambda xs: (x + 1 for x in xs))(iter([1, 2]))) == [2, 3] and gone == [1]

    def fails(xs):
        yield next(xs)
        raise ValueError("bad row")

    with pytest.raises(ValueError, match="bad row"):
        list(C.lean(fails)(iter([1])))
    assert gone == [1, 1]


def test_giving_back_works_here():
    C._give_back()
