import random
import re
from collections import Counter

import numpy as np
import pytest

from reckoner.llm import minhash
from reckoner.llm.components import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bag(text):
    w = WORD.findall((text or "").lower())
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def jaccard(a, b, weight):
    both = sum(min(n, b[s]) * weight[s] for s, n in a.items() if s in b)
    return both / (sum(n * weight[s] for s, n in a.items()) + sum(n * weight[s] for s, n in b.items()) - both)


def brute_links(rows):
    """All pairs of documents of weighted Jaccard similarity 0.8 or more."""
    bags = {i: bag(t) for i, t in rows}
    df = Counter(s for b in bags.values() for s in b)
    weight = {s: np.log1p(len(rows) / max(n, minhash.FLOOR * len(rows))) for s, n in df.items()}
    ids = [i for i in bags if bags[i]]
    return [(a, b) for i, a in enumerate(ids) for b in ids[:i] if jaccard(bags[a], bags[b], weight) >= 0.8]


def classes_of(links, ids):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus():
    """A third of all rows in one family of few and many edits, small families, exact copies, a common passage."""
    rng = random.Random(8)
    text = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    passage, hot, rows = text(12), text(150), []
    rows += [edited(rng, hot, rng.randrange(0, 14)) for _ in range(150)]
    for _ in range(40):
        base = text(rng.randrange(5, 120))
        rows += [edited(rng, base, rng.randrange(0, 3)) for _ in range(rng.randrange(1, 4))]
    rows += [" ".join(text(40) + passage) for _ in range(120)]
    rows += [" ".join(hot)] * 20 + ["One, two!", "one two", "a b c d"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_classes_equal_those_of_all_links(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)
    rows = minhash.near_classes(docs).collect()
    got = {r.doc_id: r.class_id for r in rows}
    links = brute_links(corpus)
    want = classes_of(links, got)
    assert all(want[got[i]] == want[i] for i in got)  # nothing is joined without links
    assert sum(got[a] != got[b] for a, b in links) <= 0.002 * len(links)
    sizes = Counter(got.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in rows)


def test_every_shingle_weighs_by_its_own_frequency(spark, corpus, monkeypatch):
    """Frequencies of many chunks and buckets against counts over all documents."""
    monkeypatch.setattr(minhash, "CHUNK_BYTES", 6000)
    monkeypatch.setattr(minhash, "BUCKET_BYTES", 20_000)
    rows = [*corpus, (9000, None), (9001, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    minhash.ship(spark)
    signed = minhash.signatures(docs.selectExpr("doc_id", "text", "xxhash64(text) AS text_key"), len(rows), sum(len(t or "") for _, t in rows))
    bags = {i: bag(t) for i, t in rows}
    df = Counter(s for b in bags.values() for s in b)
    got = {r.doc_id: sorted(np.frombuffer(r.documents, np.uint32).tolist()) for r in signed.collect()}
    assert got == {i: sorted(df[s] for s in b) for i, b in bags.items()}


@pytest.mark.parametrize("asked_of", ["repeated", "all"])
def test_equal_sets_of_shingles_count_once(spark, corpus, monkeypatch, asked_of):
    """Copies, also of other case and blanks, over many chunks; the Bloom filter may take any document for a copy."""
    monkeypatch.setattr(minhash, "CHUNK_BYTES", 6000)
    monkeypatch.setattr(minhash, "BUCKET_BYTES", 20_000)
    rows = [*corpus, *[(8000 + i, t.upper().replace(" ", "  ")) for i, t in corpus[::3]], (9000, None), (9001, " "), (9002, ""), (9003, "!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("doc_id", "text", "xxhash64(text) AS text_key")
    minhash.ship(spark)
    size = sum(len(t or "") for _, t in rows)
    chunks = minhash.chunked(docs, size)
    repeated = minhash.repeated_prints(chunks)
    bags = {i: bag(t) for i, t in rows}
    sets = Counter(frozenset(b.items()) for b in bags.values() if b)
    assert sorted(r.n for r in repeated.collect()) == sorted(n for n in sets.values() if n > 1)
    if asked_of == "all":
        repeated = chunks.select("packed").mapInArrow(minhash._prints, "print long")
    df = Counter(s for b in sets for s, _ in b)
    signed = minhash.signatures(docs, len(sets), size, chunks, repeated)
    got = {r.doc_id: sorted(np.frombuffer(r.documents, np.uint32).tolist()) for r in signed.collect()}
    assert got == {i: sorted(df[s] for s in b) for i, b in bags.items()}


def test_near_copies_in_large_groups_of_copies(spark):
    """Sixty exact copies and near ones of 0.82 to 0.86 by shingles; as many near ones of another text that has no exact copy."""
    words = lambda start, n: [f"w{i}" for i in range(start, start + n)]
    rows = [" ".join(words(1000 * i, 12)) for i in range(100, 3100)]
    groups = []
    for g in range(2):
        base, copies = words(500 * g, 104), []
        for k in range(12):
            near = list(base)
            for j in range(2):  # ten shingles of a hundred, or eight
                near[(37 * j + 5 * k + 11) % 98 + 3] = f"edit{g}x{k}x{j}"
            copies.append(" ".join(near))
        groups.append([" ".join(base)] * (60 if g == 0 else 1) + copies)
    rows = groups[0] + groups[1] + rows
    got = {r.doc_id: r.class_id for r in minhash.near_classes(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert got == {i: 0 if i < 72 else 72 if i < 85 else i for i in range(len(rows))}


def test_an_edit_weighs_no_more_in_a_larger_corpus():
    """What a group of a thousandth of all documents shares against an edit of one of them, of two different shingles in a hundred."""
    for total in (10**4, 10**6, 3 * 10**8):
        shared, edit = minhash.inverse_frequency(np.array([total // 1000, 1]), total)
        assert 85 * shared / (85 * shared + 15 * edit) >= 0.84
        common, rarer = minhash.inverse_frequency(np.array([total // 10, total // 30]), total)
        assert common < 0.75 * rarer < 0.6 * edit


def test_a_passage_of_some_documents_weighs_less(spark):
    """Eight of 200 texts are a common passage and six words of their own: 0.82 alike by shingles, 0.74 by TF-IDF."""
    words = lambda start, n: " ".join(f"w{i}" for i in range(start, start + n))
    rows = [(i, f"{words(0, 60)} {words(1000 + 10 * i, 6)}") for i in range(8)] + [(i, words(10_000 + 50 * i, 40)) for i in range(8, 198)]
    rows += [(198, f"{words(50_000, 66)}"), (199, f"{words(50_000, 60)} {words(60_000, 6)}")]  # as alike, but of no common passage
    got = {r.doc_id: r.class_id for r in minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: min(i, 198) for i in range(200)}


def test_samples_agree_as_often_as_the_weighted_similarity():
    rng = np.random.default_rng(4)
    shingles = np.sort(rng.choice(1 << 40, 300, replace=False)).astype(np.uint64)
    wa, wb = rng.gamma(2.0, 1.0, 300).astype(np.float32), rng.gamma(2.0, 1.0, 300).astype(np.float32)
    a, b = slice(0, 240), slice(40, 300)
    drawn = [minhash.samples(np.zeros(len(shingles[s]), int), shingles[s], w[s], 4000) for s, w in ((a, wa), (b, wb))]
    x, y = np.zeros(300), np.zeros(300)
    x[a], y[b] = wa[a], wb[b]
    want = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    assert (drawn[0] == drawn[1]).mean() == pytest.approx(want, abs=0.03)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 600)]
    got = {r.u: r.v for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = classes_of(edges, {i for e in edges for i in e})
    assert {i: v for i, v in want.items() if v != i} == got


def test_edges(edge, empty):
    rows = minhash.near_classes(edge).collect()
    assert len(rows) == edge.count() and minhash.near_classes(empty).count() == 0
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert sum(r.kept for r in by[1]) == 1 and {r.class_id for r in by[1] + by[2]} == {1}
    assert all(r.kept and r.class_size == 1 for i in (3, 4, 5, 6) for r in by[i])
    assert {r.class_id for r in by[None]} == {None, 1}
