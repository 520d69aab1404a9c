import random
import re
from hashlib import sha256

import numpy as np
import pytest

from reckoner.llm import repeats


def brute(rows, length=50):
    order = lambda i: (i is None, i or 0)
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for i, text in rows]
    first = {}
    for i, words in split:
        for s in range(len(words) - length + 1):
            key = tuple(words[s : s + length])
            first[key] = min(first.get(key, order(i)), order(i))
    out = []
    for i, words in split:
        gone = set()
        for s in range(len(words) - length + 1):
            if first[tuple(words[s : s + length])] < order(i):
                gone.update(range(s, s + length))
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        out.append((i, len(words), len(gone), sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def result(docs, length=50):
    rows = repeats.remove_repeats(docs, length, keep_text=True).collect()
    return sorted((tuple(r) for r in rows), key=str)


def given(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_edges(edge):
    """NULL ids and texts, empty, blank and long texts, repeated rows and ids, clashing columns."""
    assert result(edge) == brute(given(edge))
    assert result(edge, 9) == brute(given(edge), 9)


def family(seed):
    """Passages in many documents, cut at any place, with edits, next to each other and inside one another."""
    rng = random.Random(seed)
    word = lambda: f"{rng.choice('abcdefgh')}{rng.randrange(300)}"
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 60, 75, 120, 300)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            low, high = (0, len(p)) if rng.random() < 0.4 else sorted(rng.sample(range(len(p) + 1), 2))
            part = p[low:high]
            if part and rng.random() < 0.4:
                part = [*part]
                part[rng.randrange(len(part))] = "edit" + str(rng.randrange(3))
            words += part + [word() for _ in range(rng.choice([0, 0, 1, 30]))]
        blank = rng.choice([" ", "  ", "\n", "\x0b"])
        rows.append((rng.choice([i, i // 3, None]) if rng.random() < 0.2 else 1000 - i, blank.join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_cut_anywhere(spark, seed):
    rows = family(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows)
    assert sum(r[2] > 0 for r in want) > 40
    assert result(docs) == want


@pytest.mark.parametrize("length", [2, 5, 8])
def test_few_words_with_many_equal_runs(spark, length):
    """Two or three words only: equal anchors overlap, and most windows have many holders."""
    rng = random.Random(length)
    rows = [(rng.randrange(60), " ".join(rng.choice(["a", "b", "b", "é"][: rng.choice([2, 4])]) for _ in range(rng.randrange(30)))) for _ in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(docs, length) == brute(rows, length)


def test_text_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [("b", text), ("a", text + " end")]
    assert result(spark.createDataFrame(rows, "doc_id string, text string")) == sorted(
        [("a", 61, 0, sha256((text + " end").encode()).hexdigest(), text + " end"), ("b", 60, 60, sha256(b"").hexdigest(), "")], key=str
    )


def test_least_places_takes_the_last_of_equal_ones():
    rng = np.random.default_rng(0)
    for width in (1, 2, 3, 5, 26):
        values = rng.integers(0, 5, 200).astype(np.uint64)
        want = [s + width - 1 - int(np.argmin(values[s : s + width][::-1])) for s in range(200 - width + 1)]
        assert repeats.least_places(values, width).tolist() == want


def test_empty_table(empty):
    assert repeats.remove_repeats(empty).count() == 0
