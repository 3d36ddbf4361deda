"""Word handling against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from kestrel.llm.textblocks import ASCII_LOWER, blocks, count_words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t漢 x ", max_size=30)), max_size=12)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(max_examples=80, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_match_the_pattern(texts, block_bytes):
    column = pa.array(texts, pa.string())
    got = []
    for b in blocks(column, block_bytes):
        raw = b.data.tobytes()
        for d in range(b.n_docs):
            at = range(b.first_word[d], b.first_word[d + 1])
            got.append([raw[b.word_start[i]: b.word_end[i]].decode() for i in at])
    assert got == [words(t) for t in texts]
    assert count_words(column).tolist() == [len(words(t)) for t in texts]


def test_hashes_follow_content_only():
    column = pa.array(["alpha Beta gamma", "x alpha beta", "gamma alpha beta gamma"])
    b = next(blocks(column))
    folded = b.word_hashes(ASCII_LOWER)
    grams, at = b.ngrams(folded, 2)
    by_pair = {}
    raw = b.data.tobytes().lower()
    for g, i in zip(grams.tolist(), at.tolist()):
        pair = raw[b.word_start[i]: b.word_end[i]], raw[b.word_start[i + 1]: b.word_end[i + 1]]
        by_pair.setdefault(pair, set()).add(g)
    assert all(len(v) == 1 for v in by_pair.values())
    assert len({next(iter(v)) for v in by_pair.values()}) == len(by_pair) == 4
    assert len(at) == 2 + 2 + 3


def test_sliced_arrays_and_empty_columns():
    column = pa.array(["zero", "a b", None, "c"]).slice(1, 3)
    assert count_words(column).tolist() == [2, 0, 1]
    assert count_words(pa.array([], pa.string())).tolist() == []
    assert np.array_equal(count_words(pa.chunked_array([["a"], ["b c"]])), [1, 2])
