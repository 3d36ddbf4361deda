"""Toxicity scores from a bidirectional gated recurrent network (operator 7).

A text is read in overlapping windows of ``window`` words, ``stride`` apart. Each
word enters with two embeddings: one of the hashed word (ASCII lower-cased,
without punctuation around it) and the mean of those of its hashed character
n-grams (short and long ones, those at the start of the word apart). Two gated recurrent units read the window in either direction,
attention pools their states, and a logistic output scores the window. A text
scores as its highest window.

Training is numpy, on the driver, on a bounded sample: at most ``sample`` labelled
texts, half of each class where there are enough, picked by hash. Embeddings
start from the log-odds between the classes. In each round every window
of every sample text is scored, and each text teaches through its highest window
(texts without toxicity also through a random one), so that the label of a text
finds the place that earned it.

Scoring covers every window of every text. All words of a block are embedded once
per distinct word, and each step of the network is a matrix product over all
windows of the block.

Null and empty texts have no window and score 0. Without labels of both classes
every text scores 0. Repeated rows get equal scores; an empty table gives an
empty result. Input columns named like the score are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.common import extended, with_arrays
from kestrel.llm.textblocks import ASCII_LOWER, Block, Roller, blocks, mix64

WINDOW, STRIDE = 32, 16
SAMPLE = 4000
WORD_BUCKETS, CHAR_BUCKETS = 1 << 16, 1 << 16
CHAR_GRAMS = (3, 6)  # bytes
PRIOR, LEAST_SEEN = 2.0, 4
EMBED, HIDDEN = 8, 8
ROUNDS, BATCH, RATE = 5, 128, 0.01
_BLOCK = 1 << 19
_CHUNK = 2048
_WORD = Roller(83)
_U = np.uint64
_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True


@dataclass
class Words:
    """Words of a block: the distinct ones, and which one each word is."""

    bucket: np.ndarray        # word bucket of each distinct word
    char_bucket: np.ndarray   # n-gram buckets of the distinct words, one after the other
    char_start: np.ndarray    # where each distinct word's n-grams start; one more at the end
    index: np.ndarray         # distinct word of each word


def read_words(b: Block) -> Words:
    data = ASCII_LOWER[b.data]
    lo, hi = b.word_start.copy(), b.word_end.copy()
    for _ in range(4):  # punctuation around the word; one byte always stays
        lo += _PUNCT[data[lo]] & (hi - lo > 1) if len(lo) else 0
        hi -= _PUNCT[data[hi - 1]] & (hi - lo > 1) if len(hi) else 0
    keys = _WORD.slices(_WORD.prefix(_WORD.table[data]), lo, hi)
    distinct, first, index = np.unique(keys, return_index=True, return_inverse=True)
    lo, hi = lo[first], hi[first]
    # At each byte of a distinct word one gram of each length, cut at the word's end;
    # grams at the start of a word are told apart.
    size = hi - lo
    start = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(lo - start[:-1], size) + np.arange(start[-1])
    stop = np.repeat(hi, size)
    mark = np.zeros(len(at), dtype=_U)
    mark[start[:-1]] = _U(1 << 40)
    prefix = _WORD.prefix(_WORD.table[data])
    grams = [mix64(_WORD.slices(prefix, at, np.minimum(at + n, stop)) ^ mark) % _U(CHAR_BUCKETS) for n in CHAR_GRAMS]
    both = np.stack(grams, axis=1).reshape(-1).astype(np.int32)
    return Words((distinct % _U(WORD_BUCKETS)).astype(np.int32), both, start * len(CHAR_GRAMS), index.astype(np.int32))


def read_texts(texts: list[str]) -> tuple[Words, np.ndarray]:
    """Words of many texts, read block by block, and where each text's words start
    (one more at the end). A word may be listed once per block."""
    parts, counts, known, grams = [], [], 0, 0
    for b in blocks(pa.array(texts, pa.large_string()), _BLOCK):
        w = read_words(b)
        parts.append(Words(w.bucket, w.char_bucket, w.char_start[:-1] + grams, w.index + np.int32(known)))
        known, grams = known + len(w.bucket), grams + len(w.char_bucket)
        counts.append(b.n_words)
    joined = [np.concatenate([getattr(p, f) for p in parts]) for f in ("bucket", "char_bucket", "char_start", "index")]
    joined[2] = np.append(joined[2], grams)
    return Words(*joined), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


def cut_windows(first_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, words) of every window; every word is in one at least."""
    n = np.diff(first_word)
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    doc = np.repeat(np.arange(len(n)), count)
    turn = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = turn * STRIDE
    return doc, first_word[:-1][doc] + start, np.minimum(n[doc] - start, WINDOW)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _scan(x: np.ndarray, mask: np.ndarray, u: np.ndarray):
    """States of one unit over (steps, windows, 3 * HIDDEN) inputs; masked steps
    keep the state."""
    steps, n, _ = x.shape
    h = np.zeros((n, HIDDEN), dtype=np.float32)
    states = np.empty((steps + 1, n, HIDDEN), dtype=np.float32)
    gates = np.empty((steps, 4, n, HIDDEN), dtype=np.float32)
    states[0] = h
    for t in range(steps):
        hu = h @ u
        both = _sigmoid(x[t, :, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
        z, r = both[:, :HIDDEN], both[:, HIDDEN:]
        new = np.tanh(x[t, :, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])
        step = (1.0 - z) * mask[t][:, None]
        gates[t, 0], gates[t, 1], gates[t, 2], gates[t, 3] = z, r, new, hu[:, 2 * HIDDEN:]
        h = h + step * (new - h)
        states[t + 1] = h
    return states, gates


def _unscan(grad: np.ndarray, states: np.ndarray, gates: np.ndarray, mask: np.ndarray, u: np.ndarray):
    """Gradients of ``_scan``: of its inputs and of ``u``, from those of its states."""
    steps = len(mask)
    dx = np.empty((steps, grad.shape[1], 3 * HIDDEN), dtype=np.float32)
    du = np.zeros_like(u)
    dh = np.zeros_like(states[0])
    for t in range(steps - 1, -1, -1):
        dh = dh + grad[t]
        z, r, new, hn = gates[t]
        h, m = states[t], mask[t][:, None]
        dnew = dh * (1.0 - z) * m * (1.0 - new * new)
        dz = dh * (h - new) * m * z * (1.0 - z)
        dr = dnew * hn * r * (1.0 - r)
        dx[t] = np.concatenate([dz, dr, dnew], axis=1)
        dhu = np.concatenate([dz, dr, dnew * r], axis=1)
        du += h.T @ dhu
        dh = dh * (1.0 - (1.0 - z) * m) + dhu @ u.T
    return dx, du


@dataclass
class Network:
    """Weights by name; all float32."""

    w: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def started(seed: int) -> "Network":
        rng = np.random.default_rng(seed)
        normal = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
        w = {"word": normal(WORD_BUCKETS, EMBED, s=0.05), "char": normal(CHAR_BUCKETS, EMBED, s=0.05)}
        for way in ("f", "b"):
            w["x" + way] = normal(2 * EMBED, 3 * HIDDEN, s=0.4)
            w["c" + way] = np.zeros(3 * HIDDEN, dtype=np.float32)
            w["u" + way] = normal(HIDDEN, 3 * HIDDEN, s=0.3)
        w |= {"a": normal(2 * HIDDEN, HIDDEN, s=0.4), "v": normal(HIDDEN, s=0.4), "o": normal(2 * HIDDEN, s=0.4),
              "bias": np.full(1, -1.0, dtype=np.float32)}
        return Network(w)

    def embed(self, words: Words) -> np.ndarray:
        """Input of each distinct word: word embedding and mean n-gram embedding."""
        if not len(words.bucket):
            return np.empty((0, 2 * EMBED), dtype=np.float32)
        sums = np.add.reduceat(self.w["char"][words.char_bucket], words.char_start[:-1], axis=0)
        mean = sums / np.diff(words.char_start)[:, None].astype(np.float32)
        return np.concatenate([self.w["word"][words.bucket], mean], axis=1)

    def projected(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        return {way: inputs @ self.w["x" + way] + self.w["c" + way] for way in ("f", "b")}

    def forward(self, projected: dict[str, np.ndarray], index: np.ndarray, mask: np.ndarray):
        """Logits of windows: ``index`` (steps, windows) names distinct words."""
        sf, gf = _scan(projected["f"][index], mask, self.w["uf"])
        sb, gb = _scan(projected["b"][index[::-1]], mask[::-1], self.w["ub"])
        h = np.concatenate([sf[1:], sb[1:][::-1]], axis=2)
        key = np.tanh(h @ self.w["a"])
        weight = np.where(mask > 0, key @ self.w["v"], -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (h * weight[:, :, None]).sum(axis=0)
        return pooled @ self.w["o"] + self.w["bias"][0], (sf, gf, sb, gb, h, key, weight, pooled)

    def gradients(self, words: Words, inputs: np.ndarray, index: np.ndarray, mask: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean logistic loss over the given windows."""
        logit, (sf, gf, sb, gb, h, key, weight, pooled) = self.forward(self.projected(inputs), index, mask)
        d = ((_sigmoid(logit) - target) / len(target)).astype(np.float32)
        g = {"o": pooled.T @ d, "bias": d.sum(keepdims=True)}
        dpool = d[:, None] * self.w["o"]
        dweight = (h * dpool).sum(axis=2)
        dscore = weight * (dweight - (weight * dweight).sum(axis=0))
        dkey = dscore[:, :, None] * self.w["v"] * (1.0 - key * key)
        g["v"] = (key * dscore[:, :, None]).sum(axis=(0, 1))
        g["a"] = np.tensordot(h, dkey, axes=([0, 1], [0, 1]))
        dh = weight[:, :, None] * dpool + dkey @ self.w["a"].T
        dxf, g["uf"] = _unscan(dh[:, :, :HIDDEN], sf, gf, mask, self.w["uf"])
        dxb, g["ub"] = _unscan(dh[::-1, :, HIDDEN:], sb, gb, mask[::-1], self.w["ub"])
        dinputs = np.zeros_like(inputs)
        for way, dx, at in (("f", dxf, index), ("b", dxb, index[::-1])):
            flat, rows = dx.reshape(-1, 3 * HIDDEN), at.reshape(-1)
            g["x" + way] = inputs[rows].T @ flat
            g["c" + way] = flat.sum(axis=0)
            np.add.at(dinputs, rows, flat @ self.w["x" + way].T)
        used = np.unique(index)
        g["word"], g["char"] = np.zeros_like(self.w["word"]), np.zeros_like(self.w["char"])
        np.add.at(g["word"], words.bucket[used], dinputs[used, :EMBED])
        size = np.diff(words.char_start)[used]
        at = np.repeat(words.char_start[used] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        np.add.at(g["char"], words.char_bucket[at], np.repeat(dinputs[used, EMBED:] / size[:, None], size, axis=0))
        return g

    def window_logits(self, words: Words, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        projected = self.projected(self.embed(words))
        out = [np.empty(0, dtype=np.float32)]
        for lo in range(0, len(start), _CHUNK):
            index, mask = window_index(words, start[lo: lo + _CHUNK], size[lo: lo + _CHUNK])
            out.append(self.forward(projected, index, mask)[0])
        return np.concatenate(out)


def window_index(words: Words, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    step = np.arange(WINDOW)[:, None]
    mask = (step < size).astype(np.float32)
    return words.index[np.minimum(start + step, len(words.index) - 1)], mask


def document_scores(network: Network, b: Block) -> np.ndarray:
    """Highest window score of each document of a block; 0 without words."""
    scores = np.zeros(b.n_docs)
    if len(b.word_start):
        doc, start, size = cut_windows(b.first_word)
        logits = network.window_logits(read_words(b), start, size)
        np.maximum.at(scores, doc, _sigmoid(logits.astype(np.float64)))
    return scores


def train(texts: list[str], labels: np.ndarray, seed: int = 7, rounds: int = ROUNDS) -> Network:
    """Fit a network to texts with labels 0 or 1."""
    network, rng = Network.started(seed), np.random.default_rng(seed)
    words, first_word = read_texts(texts)
    n_docs = len(texts)
    doc, start, size = cut_windows(first_word)
    keep = np.diff(first_word) > 0
    # Log-odds of each bucket between the classes, by documents that hold it.
    for name, limits in (("word", None), ("char", words.char_start)):
        seen = np.zeros((2, len(network.w[name])))
        for d in range(n_docs):
            own = np.unique(words.index[first_word[d]: first_word[d + 1]])
            if limits is None:
                held = words.bucket[own]
            else:
                held = words.char_bucket[np.concatenate([np.arange(limits[i], limits[i + 1]) for i in own.tolist()])] if len(own) else own
            seen[labels[d], np.unique(held)] += 1
        total = np.array([(labels == 0).sum(), (labels == 1).sum()])[:, None]
        share = (seen + PRIOR) / (total + 2 * PRIOR)
        network.w[name][:, 0] = (np.log(share[1] / share[0]) * (seen.sum(axis=0) >= LEAST_SEEN)).astype(np.float32)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.w.items()}
    first, last = np.searchsorted(doc, np.arange(n_docs)), np.searchsorted(doc, np.arange(n_docs), side="right")
    turn = 0
    for _ in range(rounds):
        logits = network.window_logits(words, start, size)
        order = np.lexsort((logits, doc))
        highest = order[last[keep] - 1]
        clean = np.flatnonzero(keep & (labels == 0))
        other = first[clean] + (rng.random(len(clean)) * (last[clean] - first[clean])).astype(np.int64)
        chosen = rng.permutation(np.concatenate([highest, other]))
        for lo in range(0, len(chosen), BATCH):
            at = chosen[lo: lo + BATCH]
            index, mask = window_index(words, start[at], size[at])
            used, local = np.unique(index, return_inverse=True)
            part = _subset(words, used)
            grads = network.gradients(part, network.embed(part), local.reshape(index.shape), mask, labels[doc[at]].astype(np.float32))
            turn += 1
            for name, g in grads.items():
                m, v = moment[name]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                network.w[name] -= (RATE * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.999 ** turn)) + 1e-8)).astype(np.float32)
    return network


def _subset(words: Words, used: np.ndarray) -> Words:
    """Only the given distinct words."""
    size = np.diff(words.char_start)[used]
    start = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(words.char_start[used] - start[:-1], size) + np.arange(start[-1])
    return Words(words.bucket[used], words.char_bucket[at], start, np.arange(len(used)))


def fit(labelled: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample: int = SAMPLE, seed: int = 7) -> Network | None:
    """Train on at most ``sample`` rows of ``labelled`` (id, label) and their texts."""
    rows = (labelled.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y"))
            .where("i is not null and y in (0, 1)").groupBy("i").agg(F.max("y").alias("y")))
    order = F.xxhash64(F.lit(seed), "i")
    picked = None
    for label in (0, 1):
        some = rows.where(F.col("y") == label).orderBy(order, "i").limit(sample // 2)
        picked = some if picked is None else picked.union(some)
    texts = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t")).where("t is not null")
    # At most ``sample`` ids: small enough to send to every task.
    got = texts.join(F.broadcast(picked), F.col("d") == F.col("i")).select("d", "t", "y").dropDuplicates(["d"]).toPandas().sort_values("d")
    labels = got["y"].to_numpy().astype(np.int64)
    if not len(labels) or labels.min() == labels.max():
        return None
    return train(got["t"].tolist(), labels, seed)


def _score_batches(network: Network | None, text_col: str, score_out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if network is None:
                scores = np.zeros(batch.num_rows)
            else:
                parts = [document_scores(network, b) for b in blocks(batch.column(text_col), _BLOCK)]
                scores = np.concatenate(parts) if parts else np.empty(0)
            yield with_arrays(batch, **{score_out: pa.array(scores, pa.float64())})
    return run


def score(df: DataFrame, network: Network | None, text_col: str = "text", score_out: str = "score") -> DataFrame:
    """All columns of ``df`` with the toxicity score."""
    return df.mapInArrow(_score_batches(network, text_col, score_out), extended(df, **{score_out: T.DoubleType()}))
