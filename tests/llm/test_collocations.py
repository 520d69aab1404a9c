import random
import re
from collections import Counter

import numpy as np
import pytest

from reckoner.llm import bitfilter, collocations
from reckoner.llm.bytewords import mix


def brute(rows, longest, least, top=2000, within=50):
    counts, totals = {k: Counter() for k in range(1, longest + 1)}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in counts:
                counts[k].update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for length in range(2, longest + 1):
        for (lang, *words), a in counts[length].items():
            if a < least:
                continue
            holders = [
                f for k in range(length + 1, longest + 1) for (other, *w), f in counts[k].items()
                if other == lang and f >= least and 100 * f >= within * a and any(w[i : i + length] == words for i in range(k - length + 1))
            ]
            if holders:
                continue
            f = lambda w: counts[len(w)][(lang, *w)]
            score, k = min((10**6 * a * a // (f(words[:k]) * f(words[k:])), k) for k in range(1, length))
            out.append((lang, " ".join(words), a, f(words[:k]), f(words[k:]), totals[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    nth, ranked = Counter(), []
    for lang, *rest in out:
        nth[lang] += 1
        if nth[lang] <= top:
            ranked.append((lang, nth[lang], *rest))
    return sorted(ranked)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def given(df):
    return [(r["text"], r["lang"]) for r in df.select("text", "lang").collect()]


def noise(n, seed, words=30):
    rng = random.Random(seed)
    said = [f"w{i}" for i in range(words)] + ["Ünï", "don't", "a\tb", "x  y"]
    ends = [" "] * 12 + [". ", ",", "!\n", "\t", "\x0b", " "]
    pick = lambda: said[int(len(said) * rng.random() ** 2)]
    return [("".join(pick() + rng.choice(ends) for _ in range(rng.randrange(200))), rng.choice(["en", "en", "fr", None, "und"])) for _ in range(n)]


def test_edges(edge):
    """NULL texts and languages, empty and long texts, repeated rows, clashing columns."""
    assert result(collocations.collocations(edge, least=2)) == brute(given(edge), 3, 2)


@pytest.mark.parametrize("known", [None, 20])
def test_phrases_and_ties(spark, monkeypatch, known):
    """All items ranked, and most beyond the ranks."""
    if known:
        monkeypatch.setattr(collocations, "RANKED", known)
    docs = spark.createDataFrame(noise(300, 3), "text string, lang string").repartition(4)
    want = brute(given(docs), 3, 10)
    assert len(want) > 300
    assert result(collocations.collocations(docs)) == want


def test_longer_phrases_first_of_many_shards(spark):
    rows = noise(60, 4, 6)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert result(collocations.collocations(docs, longest=4, least=3, top=10)) == brute(rows, 4, 3, 10)


def test_tiles_of_long_and_short_lists():
    """Lists added to a dense tile and lists merged in order give what a dictionary counts."""
    rng = np.random.default_rng(1)
    want, rows = Counter(), []
    for n in (50_000, 40_000, 3000, 10, 0):
        first, second = rng.integers(0, 1200, n) ** 2 // 1200, rng.integers(0, 1200, n) ** 2 // 1200
        keys, counts = np.unique(collocations.address(first, second), return_counts=True)
        want.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        rows.append((keys, counts))
    sizes = np.unique(rows[0][0] >> np.uint64(16), return_counts=True)[1]
    assert sizes.max() >= collocations.DENSE_FROM > sizes.min()
    ((keys, counts),) = collocations.tile_counts(iter(rows))
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == want
    first, second = collocations.ranks_at(keys)
    assert (collocations.address(first, second) == keys).all()


def test_scores_beyond_64_bits(spark):
    a, left, right = 3 * 10**12 + 7, 5 * 10**12 + 1, 4 * 10**12 + 3
    row = spark.createDataFrame([(a, [left], [right])], "n long, first_n array<long>, last_n array<long>")
    assert row.select(collocations.cut(1, 2).alias("c")).first()["c"]["score"] == 10**6 * a * a // (left * right)


def test_two_words_of_one_key_fail(spark, monkeypatch):
    words = spark.createDataFrame([(1, "en", "a", 20), (1, "en", "b", 20)], "key long, lang string, word string, n long")
    monkeypatch.setattr(collocations, "count_words", lambda docs: (None, words))
    with pytest.raises(ValueError, match="share a key"):
        collocations.phrases(None)


def test_empty_table(empty):
    assert collocations.collocations(empty).count() == 0


def test_filter_is_held_as_bits(spark):
    """Sixteen megabytes at most, and nothing that was put in is missing."""
    assert (1 << bitfilter.MAX_LOG2_BITS) // 8 == 16 << 20
    for n in (10, 300_000):
        hashes = mix(np.arange(1, n + 1, dtype=np.uint64))
        bits = bitfilter.log2_bits(n)
        df = spark.createDataFrame([(int(x),) for x in hashes.view(np.int64)[:2000]], "h long")
        table = bitfilter.build(df, "h", bits)
        assert table.nbytes == (1 << bits) // 8
        assert len(bitfilter.may_hold(table, hashes[:2000])) == min(n, 2000)
        other = mix(np.arange(n + 1, n + 20_001, dtype=np.uint64))
        assert len(bitfilter.may_hold(table, other)) < 500
