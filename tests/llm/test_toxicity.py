"""Toxicity network: gradients, windows, held-out accuracy, odd rows."""

import random

import numpy as np
import pyarrow as pa

from kestrel.llm import toxicity
from kestrel.llm.queries import op7_toxicity
from kestrel.llm.textblocks import blocks
from kestrel.llm.toxicity import Network, cut_windows, document_scores, fit, read_texts, read_words, score, train, window_index

CHECK = "/root/testdata/sf0.01"


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    b = next(blocks(pa.array(["you are an odd friend " * 9, "the cat sat", "a"])))
    words = read_words(b)
    doc, start, size = cut_windows(b.first_word)
    net = Network.started(1)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    index, mask = window_index(words, start, size)
    y = np.array([1.0, 0.0, 1.0, 0.0, 1.0])[: len(start)]

    def loss():
        logit = net.forward(net.projected(net.embed(words)), index, mask)[0]
        return np.mean(np.log1p(np.exp(logit)) - y * logit)

    grads = net.gradients(words, net.embed(words), index, mask, y)
    assert set(grads) == set(net.w)
    for name, g in grads.items():
        i = int(np.abs(g).argmax())
        flat, step = net.w[name].reshape(-1), 1e-3
        old = flat[i]
        flat[i] = old + step
        up = loss()
        flat[i] = old - step
        down = loss()
        flat[i] = old
        assert abs((up - down) / (2 * step) - g.reshape(-1)[i]) < 2e-2 * abs(g.reshape(-1)[i]) + 1e-6, name


def test_windows_cover_and_overlap():
    for n in (1, 15, 16, 17, 31, 32, 33, 48, 49, 200):
        doc, start, size = cut_windows(np.array([0, 0, n, n]))
        assert set(doc.tolist()) == {1}
        assert {k for s, m in zip(start, size) for k in range(s, s + m)} == set(range(n))
        assert all(m == min(toxicity.WINDOW, n - s) for s, m in zip(start, size))
        assert all(b - a == toxicity.STRIDE for a, b in zip(start, start[1:]))


def test_reading_in_blocks_changes_nothing():
    texts = ["Hello, WORLD! (really)", "", "a b c" * 40, "hello world"]
    words, first = read_texts(texts)
    b = next(blocks(pa.array(texts)))
    whole = read_words(b)
    assert first.tolist() == b.first_word.tolist()
    assert words.bucket[words.index].tolist() == whole.bucket[whole.index].tolist()
    assert words.bucket[words.index[0]] == words.bucket[words.index[first[3]]]  # punctuation and case go


def planted(n, seed):
    rng = random.Random(seed)
    texts, labels = [], []
    for k in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 200))]
        labels.append(k % 2)
        if k % 2:
            for bad in rng.sample(["vile", "rotten", "filthy"], 2):
                words.insert(rng.randrange(len(words)), bad)
        texts.append(" ".join(words))
    return texts, np.array(labels)


def test_learns_words_at_any_place():
    network = train(*planted(400, 1))
    texts, labels = planted(200, 2)
    scores = np.concatenate([document_scores(network, b) for b in blocks(pa.array(texts), 2000)])
    assert ((scores >= 0.5) == labels).mean() >= 0.95
    late = " ".join(["w1"] * 5000 + ["vile", "rotten"])  # whole texts count
    assert document_scores(network, next(blocks(pa.array([late, "w1 " * 5000])))).round().tolist() == [1, 0]


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{CHECK}/labels.parquet")
    rows = op7_toxicity(spark, CHECK)
    assert rows.count() == spark.read.parquet(f"{CHECK}/documents.parquet").count()
    held = rows.where("held_out").join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.88 * len(held)
    assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in held)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 1), (12, 1), (9, 0), (13, 0), (14, 0), (None, 1), (4, None), (5, 0), (77, 1)], "doc_id bigint, toxic int")
    network = fit(labels, odd_docs)
    rows = score(odd_docs, network).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows if r["doc_id"] in (4, 5, 6)} == {0.0}
    assert len({r["score"] for r in rows if r["doc_id"] == 7}) == 1
    assert score(no_docs, network).count() == 0
    assert fit(labels.where("toxic = 0"), odd_docs) is None
    assert {r["score"] for r in score(odd_docs, None).collect()} == {0.0}
