"""The two classifiers: held-out accuracy, gradients, and edge cases."""

import math
import random
import re
import zlib

import numpy as np
import pytest

from reckoner.llm import quality, toxicity
from reckoner.llm.bytewords import ALPHANUMERIC, LOWER, mix, words_of

LABELS = "doc_id long, quality int, toxic int"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(6)
    syllables = ["ka", "lo", "mi", "zu", "ren", "ta", "so"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    docs, labels = [], []
    for i in range(500):
        words = [word() for _ in range(rng.randrange(5, 90))]
        junk, toxic = rng.random() < 0.3, rng.random() < 0.3
        if toxic:
            for _ in range(2):
                words[rng.randrange(len(words))] = rng.choice(["idioto", "vequ" + word()])
        text = " ".join(w + rng.choice(["$$$", "###"]) for w in words) if junk else " ".join(words)
        docs.append((i, text))
        labels.append((i, int(not junk), int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(4).cache(), spark.createDataFrame(labels, LABELS)


@pytest.mark.parametrize(("module", "label", "threshold", "least"), [(quality, "quality", 0.3, 0.97), (toxicity, "toxic", 0.5, 0.85)])
def test_held_out_accuracy(corpus, module, label, threshold, least):
    docs, labels = corpus
    model = module.learn(docs, labels)
    rows = module.score(docs, model, threshold).join(labels, "doc_id").collect()
    assert len(rows) == docs.count() and all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= threshold) for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.predicted == r[label] for r in unseen) / len(unseen) >= least


def test_whole_texts_count(spark, corpus):
    """Junk and toxic words at the very end of a long text are seen."""
    docs, labels = corpus
    clean = "kalomi zuren taso " * 3000
    rows = spark.createDataFrame([(0, clean), (1, clean + "idioto vequka idioto")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(rows, toxicity.learn(docs, labels), 0.5).collect()}
    assert got[0] < 0.5 < got[1]


def test_end_of_a_long_text_counts_for_quality(spark, corpus):
    docs, labels = corpus
    clean = "kalomi zuren taso " * 3000
    rows = spark.createDataFrame([(0, clean), (1, clean + "ka$$$ lo### mi$$$ " * 40)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality.score(rows, quality.learn(docs, labels), 0.3).collect()}
    assert got[1] < got[0]


def laid(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.r_[0, np.cumsum([len(d) for d in data])]


TEXTS = ["", "a", "é", "?!", "one two three", "Ünïcode ÀÉ straße " * 40, "x" * 600, " ".join(f"W{i} v{i * i}" for i in range(70)), "y z " * 300]


def test_quality_equals_a_naive_pass():
    """Each filter at each place, blocks, chunks of two blocks, mean and maximum, one by one."""
    net = quality.Network(0.4, np.random.default_rng(2))
    net.bias[:] = np.linspace(-0.1, 0.1, quality.FILTERS)
    for text, got in zip(TEXTS, net.scores(*laid(TEXTS)), strict=True):
        data = text.encode()
        padded = data + bytes(quality.WIDTH)
        response = [sum(net.tables[j][padded[i + j]].astype(float) for j in range(quality.WIDTH)) for i in range(len(data))]
        blocks = [np.max(response[i : i + quality.BLOCK], 0) for i in range(0, len(data), quality.BLOCK)]
        chunks = [np.maximum(np.max(blocks[i : i + 2], 0) + net.bias, 0) for i in range(len(blocks))]
        pooled = np.r_[np.mean(chunks, 0), np.max(chunks, 0)] if chunks else np.zeros(2 * quality.FILTERS)
        assert got == pytest.approx(1 / (1 + math.exp(-(pooled @ net.combine + net.offset))), rel=1e-4)


def naive_logit(p, vectors):
    """One window, word by word in both directions."""
    hidden = toxicity.HIDDEN
    ways = []
    for way in range(2):
        h, states = np.zeros(hidden), {}
        for t in range(len(vectors)) if way == 0 else reversed(range(len(vectors))):
            x = vectors[t] @ p["into"][way] + p["bias"][way]
            gates = 1 / (1 + np.exp(-(x[: 2 * hidden] + h @ p["gates"][way])))
            z, r = gates[:hidden], gates[hidden:]
            h = (1 - z) * h + z * np.tanh(x[2 * hidden :] + (r * h) @ p["state"][way])
            states[t] = h
        ways.append(states)
    both = [np.r_[ways[0][t], ways[1][t]] for t in range(len(vectors))]
    weights = [math.exp(np.tanh(b @ p["look"]) @ p["choose"]) for b in both]
    return sum(w * b for w, b in zip(weights, both, strict=True)) @ p["out"] / sum(weights) + p["offset"][0]


def test_toxicity_equals_a_naive_pass():
    """Word and n-gram vectors, every window, both directions and the attention, one by one."""
    net = toxicity.Network(0.3, np.random.default_rng(3))
    net.p["bias"] += np.linspace(-0.2, 0.2, net.p["bias"].size).reshape(net.p["bias"].shape).astype(np.float32)
    p = {k: v.astype(float) for k, v in net.p.items()}
    for text, got in zip(TEXTS, net.scores(*laid(TEXTS)), strict=True):
        vectors = []
        for word in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.encode().translate(bytes(LOWER))):
            own = words_of(np.frombuffer(word, np.uint8), np.array([0, len(word)]), ALPHANUMERIC).hashes()
            bordered = bytes(1) + word + bytes(1)
            codes = [int.from_bytes(bytes([n]) + bordered[i : i + n]) for n in toxicity.GRAMS for i in range(len(bordered) - n + 1)]
            grams = mix(np.array(codes, np.uint64)) >> np.uint64(64 - toxicity.LOG2_GRAMS)
            of_grams = p["grams"][grams.astype(np.int64)].mean(0) if codes else 0
            vectors.append(p["words"][int(own[0]) >> (64 - toxicity.LOG2_WORDS)] + of_grams)
        starts = [i for i in range(0, len(vectors), toxicity.STRIDE) if i == 0 or i < len(vectors) - toxicity.SPAN + toxicity.STRIDE]
        logits = [naive_logit(p, vectors[i : i + toxicity.SPAN]) for i in starts] or [p["offset"][0]]
        assert got == pytest.approx(1 / (1 + math.exp(-max(logits))), rel=1e-4)


def test_long_labelled_texts_teach_by_runs_from_start_to_end(spark):
    """No text is left out for its length; the runs lie evenly from the first to the last character."""
    ids = [i for i in range(60) if not held_out(i)]
    texts = {i: "".join(chr(0xE0 + (i + j) % 90) for j in range(i * 5)) for i in ids if i}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i > 30), None) for i in texts], LABELS)
    found, y, weights, counts = quality.labelled_sample(docs, labels, "quality", 1000, 64)
    run = 64 // quality.PIECES
    want = {}
    for i, text in texts.items():
        step = (len(text) - run) / (quality.PIECES - 1)
        cut = " ".join(text[math.floor(k * step + 1e-9) :][:run] for k in range(quality.PIECES))
        want[text if len(text) <= 64 else cut] = int(i > 30)
    assert {t.decode(): int(v) for t, v in zip(found, y, strict=True)} == want
    assert counts == {0: sum(i <= 30 for i in texts), 1: sum(i > 30 for i in texts)} and np.allclose(weights, 1)
    assert isinstance(quality.learn(docs, labels, longest=64), quality.Network)  # one label has long texts only


def test_blocks_equal_one_block():
    """Scores do not depend on how positions are cut into blocks."""
    rng = np.random.default_rng(1)
    net = quality.Network(0.5, rng)
    data = rng.integers(1, 255, 5000).astype(np.uint8)
    offsets = np.array([0, 0, 3, 700, 4999, 5000])
    whole = net.scores(data, offsets)
    saved, quality.POSITIONS = quality.POSITIONS, 300
    try:
        assert np.allclose(net.scores(data, offsets), whole)
    finally:
        quality.POSITIONS = saved
    alone = [net.scores(data[a:b], np.array([0, b - a]))[0] for a, b in zip(offsets[:-1], offsets[1:])]
    assert np.allclose(alone, whole)


def test_recurrent_gradients():
    net = toxicity.Network(0.3, np.random.default_rng(0))
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    data = np.frombuffer(" ".join(f"w{i % 13} xyz{i}" for i in range(30)).encode(), np.uint8)
    words = words_of(LOWER[data], np.array([0, len(data)]), ALPHANUMERIC)
    word, gram, limits, number = toxicity.inputs_of(words)
    start, length, _ = toxicity.windows_of(words.n_words, words.first)
    assert start[-1] + length[-1] == len(words) and (start[1:] < start[:-1] + length[:-1]).all()
    at = number[np.minimum(start[:, None] + np.arange(toxicity.SPAN), len(number) - 1)]
    projected = net.project(net.vectors(word, gram, limits))
    logit, kept = net.forward(at, length, projected, True)
    grads = {k: np.zeros_like(v) for k, v in net.p.items()}
    net.backward(np.ones(len(logit)), at, projected, kept, grads)
    for name, place in (("gates", (0, 1, 2)), ("gates", (1, 3, 9)), ("state", (1, 2, 3)), ("look", (5, 2)), ("choose", (1,)), ("out", (3,))):
        value, step = net.p[name][place], 1e-3
        ends = []
        for sign in (1, -1):
            net.p[name][place] = value + sign * step
            ends.append(net.forward(at, length, projected, False)[0].sum())
        net.p[name][place] = value
        assert grads[name][place] == pytest.approx((ends[0] - ends[1]) / 2 / step, rel=0.05, abs=3e-6)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_edges(spark, edge, empty, module):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(100, 130)] + [(7, None, None), (999, 1, 1), (1, 1, 1)], LABELS)
    model = module.learn(edge, labels)
    rows = module.score(edge, model, 0.5).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1
    assert module.score(empty, model, 0.5).count() == 0
    constant = module.learn(edge, labels.limit(0))
    assert {r.score for r in module.score(edge, constant, 0.5).collect()} == {0.5}
