"""Toxicity score by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the sum of a word vector and the mean of the vectors of its
character n-grams (with its borders), both in hashed tables, so an unseen word
is known by its parts. Windows of ``SPAN`` words, each overlapping the next by
a quarter, cover the whole text. Two gated recurrent layers read a window in
both directions, attention pools their states to a logit, and the document
takes its strongest window.

Learning takes a bounded sample: at most ``SAMPLE`` labelled rows of each label,
the smallest by a hash, of texts of every length, weighted back to the labels'
shares. A text over ``LONGEST`` characters teaches by evenly spaced runs of it,
``LONGEST`` characters in all (``quality.pieces_of``). Held-out rows are never
learned from. In learning, the windows of a document share its gradient by the
softmax of their logits.
The sample is learned on the driver; scoring is done in tasks over blocks of
windows of fixed size. The model, some 4 MB, is broadcast.

Cases: NULL texts and texts without words have no window and get the
probability of the offset alone. Labels that are NULL or without document are
not learned from. Without labels of both kinds the score is the share of label
1, or one half.
"""

from __future__ import annotations


import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckoner.llm.bytewords import ALPHANUMERIC, LOWER, Words, mix, words_of
from reckoner.llm.quality import Constant, labelled_sample, score

__all__ = ["learn", "score"]

SPAN, STRIDE = 32, 24
SIZE, HIDDEN, ATTENTION = 8, 8, 8
LOG2_WORDS, LOG2_GRAMS = 15, 16
GRAMS = (4, 5)
SAMPLE, LONGEST = 1500, 1 << 15
EPOCHS, BATCH, RATE, SEED = 5, 24, 0.02, 11
WINDOWS = 8192
U64 = np.uint64


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def inputs_of(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the distinct words: table row, n-gram rows and their limits; and of each word its distinct word."""
    hashes, first, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
    start, length = words.start[first], (words.end - words.start)[first]
    padded = length + 2
    limits = np.r_[0, np.cumsum(padded)]
    owner = np.repeat(np.arange(len(first)), padded)
    place = np.arange(limits[-1]) - limits[:-1][owner]
    inner = (place > 0) & (place <= length[owner])
    letters = np.zeros(limits[-1], U64)  # borders are zero
    letters[inner] = words.data[(start[owner] + place - 1)[inner]]
    grams, owners = [], []
    for n in GRAMS:
        m = max(0, len(letters) - n + 1)
        value = np.full(m, n, U64)
        for j in range(n):
            value = (value << U64(8)) | letters[j : j + m]
        whole = owner[:m] == owner[n - 1 :] if m else np.zeros(0, bool)
        grams.append(mix(value[whole]) >> U64(64 - LOG2_GRAMS))
        owners.append(owner[:m][whole])
    gram, of = np.concatenate(grams).astype(np.int64), np.concatenate(owners)
    order = np.argsort(of, kind="stable")
    return (hashes >> U64(64 - LOG2_WORDS)).astype(np.int64), gram[order], np.searchsorted(of[order], np.arange(len(first) + 1)), number


def windows_of(n_words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and document of every window."""
    counts = np.where(n_words > 0, 1 + np.maximum(0, -(-(n_words - SPAN) // STRIDE)), 0)
    doc = np.repeat(np.arange(len(n_words)), counts)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[doc] + nth * STRIDE, np.minimum(SPAN, n_words[doc] - nth * STRIDE), doc


class Network:
    """Parameters by name; two directions are stacked along the first axis."""

    def __init__(self, prior: float, rng: np.random.Generator):
        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {
            "words": normal(1 << LOG2_WORDS, SIZE, scale=0.1),
            "grams": normal(1 << LOG2_GRAMS, SIZE, scale=0.1),
            "into": normal(2, SIZE, 3 * HIDDEN, scale=SIZE**-0.5),
            "bias": np.zeros((2, 3 * HIDDEN), np.float32),
            "gates": normal(2, HIDDEN, 2 * HIDDEN, scale=HIDDEN**-0.5),
            "state": normal(2, HIDDEN, HIDDEN, scale=HIDDEN**-0.5),
            "look": normal(2 * HIDDEN, ATTENTION, scale=0.3),
            "choose": normal(ATTENTION, scale=0.3),
            "out": normal(2 * HIDDEN, scale=0.3),
            "offset": np.full(1, np.log(prior / (1 - prior)), np.float32),
        }

    def vectors(self, word, gram, limits) -> np.ndarray:
        x = self.p["words"][word].copy()
        counts = np.diff(limits)
        some = counts > 0
        if some.any():
            x[some] += np.add.reduceat(self.p["grams"][gram], limits[:-1][some], 0) / counts[some, None]
        return x

    def forward(self, at: np.ndarray, length: np.ndarray, projected: np.ndarray, keep: bool):
        """Logits of windows. ``at``: (windows, SPAN) rows of ``projected``; ``projected``: (2, words, 3 HIDDEN)."""
        n, states, tape = len(at), np.empty((2, SPAN, len(at), HIDDEN), np.float32), ([], [])
        for way in range(2):
            h = np.zeros((n, HIDDEN), np.float32)
            for t in range(SPAN) if way == 0 else range(SPAN - 1, -1, -1):
                x = projected[way].take(at[:, t], 0)
                gate = sigmoid(x[:, : 2 * HIDDEN] + h @ self.p["gates"][way])
                z, r = gate[:, :HIDDEN], gate[:, HIDDEN:]
                c = np.tanh(x[:, 2 * HIDDEN :] + (r * h) @ self.p["state"][way])
                inside = (t < length)[:, None]
                new = np.where(inside, h + z * (c - h), h)
                if keep:
                    tape[way].append((t, h, z, r, c, inside))
                h = states[way, t] = new
        both = np.concatenate([states[0], states[1]], 2)
        seen = np.tanh(both.reshape(-1, 2 * HIDDEN) @ self.p["look"]).reshape(SPAN, n, ATTENTION)
        weight = np.where(np.arange(SPAN)[:, None] < length, seen @ self.p["choose"], -np.inf)
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = (weight[:, :, None] * both).sum(0)
        logit = pooled @ self.p["out"] + self.p["offset"][0]
        return (logit, (both, seen, weight, pooled, tape)) if keep else (logit, None)

    def backward(self, d_logit: np.ndarray, at: np.ndarray, projected: np.ndarray, kept, grads: dict) -> np.ndarray:
        """Adds to ``grads``; returns the gradient of ``projected``."""
        both, seen, weight, pooled, tape = kept
        grads["out"] += pooled.T @ d_logit
        grads["offset"] += d_logit.sum()
        d_pooled = d_logit[:, None] * self.p["out"]
        d_weight = (both * d_pooled).sum(2)
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        grads["choose"] += np.tensordot(d_score, seen, ([0, 1], [0, 1]))
        d_seen = d_score[:, :, None] * self.p["choose"] * (1 - seen**2)
        grads["look"] += np.tensordot(both, d_seen, ([0, 1], [0, 1]))
        d_both = weight[:, :, None] * d_pooled + d_seen @ self.p["look"].T
        d_projected = np.zeros_like(projected)
        for way in range(2):
            d_h = np.zeros_like(tape[way][0][1])
            gates, state = self.p["gates"][way], self.p["state"][way]
            for t, h, z, r, c, inside in reversed(tape[way]):
                d_new = d_h + d_both[t, :, way * HIDDEN : (way + 1) * HIDDEN]
                d_in = np.where(inside, d_new, 0)
                d_c = d_in * z * (1 - c * c)
                d_rh = d_c @ state.T
                d_gate = np.concatenate([d_in * (c - h) * z * (1 - z), d_rh * h * r * (1 - r)], 1)
                grads["gates"][way] += h.T @ d_gate
                grads["state"][way] += (r * h).T @ d_c
                np.add.at(d_projected[way], at[:, t], np.concatenate([d_gate, d_c], 1) * inside)
                d_h = np.where(inside, d_in * (1 - z), d_new) + d_rh * r + d_gate @ gates.T
        return d_projected

    def project(self, x: np.ndarray) -> np.ndarray:
        return np.stack([x @ self.p["into"][way] + self.p["bias"][way] for way in range(2)])

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        words = words_of(LOWER[data], offsets, ALPHANUMERIC)
        out = np.full(len(offsets) - 1, self.p["offset"][0], float)
        if not len(words):
            return sigmoid(out)
        word, gram, limits, number = inputs_of(words)
        projected = self.project(self.vectors(word, gram, limits))
        start, length, doc = windows_of(words.n_words, words.first)
        logits = np.empty(len(start))
        for low in range(0, len(start), WINDOWS):
            part = slice(low, low + WINDOWS)
            at = number[np.minimum(start[part, None] + np.arange(SPAN), len(number) - 1)]
            logits[part] = self.forward(at, length[part], projected, False)[0]
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        out[doc[first]] = np.maximum.reduceat(logits, first)
        return sigmoid(out)


def train(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, prior: float) -> Network:
    rng = np.random.default_rng(SEED)
    net = Network(prior, rng)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    rounds, step = EPOCHS * -(-len(texts) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for low in range(0, len(order), BATCH):
            chosen = order[low : low + BATCH]
            data = np.frombuffer(b"".join(texts[i] for i in chosen), np.uint8)
            offsets = np.r_[0, np.cumsum([len(texts[i]) for i in chosen])]
            words = words_of(LOWER[data], offsets, ALPHANUMERIC)
            step += 1
            if not len(words):
                continue
            word, gram, limits, number = inputs_of(words)
            x = net.vectors(word, gram, limits)
            projected = net.project(x)
            start, length, doc = windows_of(words.n_words, words.first)
            at = number[np.minimum(start[:, None] + np.arange(SPAN), len(number) - 1)]
            logit, kept = net.forward(at, length, projected, True)

            first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
            most = np.repeat(np.maximum.reduceat(logit, first), np.diff(np.r_[first, len(doc)]))
            share = np.exp(logit - most)
            share /= np.repeat(np.add.reduceat(share, first), np.diff(np.r_[first, len(doc)]))
            of_doc = np.bincount(doc, share * logit, minlength=len(chosen))
            error = (sigmoid(of_doc) - labels[chosen]) * weights[chosen] / len(chosen)
            grads = {k: np.zeros_like(v) for k, v in net.p.items()}
            d_projected = net.backward((error[doc] * share).astype(np.float32), at, projected, kept, grads)
            d_x = np.zeros_like(x)
            for way in range(2):
                grads["into"][way] += x.T @ d_projected[way]
                grads["bias"][way] += d_projected[way].sum(0)
                d_x += d_projected[way] @ net.p["into"][way].T
            np.add.at(grads["words"], word, d_x)
            counts = np.diff(limits)
            np.add.at(grads["grams"], gram, np.repeat(d_x / np.maximum(counts, 1)[:, None], counts, 0))

            rate = RATE * (1 - step / (rounds + 1))
            for name, value in net.p.items():
                m, v, g = *moments[name], grads[name]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-6)
    return net


def learn(docs: DataFrame, labels: DataFrame):
    texts, y, weights, counts = labelled_sample(docs, labels, "toxic", SAMPLE, LONGEST)
    if len(set(y.tolist())) < 2:
        return Constant(counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5)
    return train(texts, y, weights, counts[1] / sum(counts.values()))
