import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from reckoner.llm import language
from reckoner.llm.bytewords import text_column

SYLLABLES = {"xx": ["ka", "lo", "mi", "zu"], "yy": ["brä", "tsch", "und", "ver"], "zz": ["eau", "oi", "ché", "que"]}


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        lang = rng.choice(sorted(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(3, 50))]
        rows.append((i, " ".join(words).title() if i % 7 == 0 else " ".join(words), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4).cache()


@pytest.fixture(scope="module")
def filters(corpus):
    return language.learn(corpus)


def test_held_out_documents_are_told(corpus, filters):
    rows = language.identify(corpus, filters).join(corpus, "doc_id").collect()
    assert all(r.held_out == held_out(r.doc_id) for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in unseen) / len(unseen) > 0.99 and all(0 <= r.score <= 1 for r in rows)


def test_popcounts_equal_exact_sets(corpus, filters):
    """Against sets of the n-grams that make up the share; false positives are the only difference."""
    counts = {}
    for r in corpus.collect():
        if not held_out(r.doc_id):
            gram, _ = language.grams_of(*text_column(pa.array([r.text.lower()])))
            for g in gram.tolist():
                counts.setdefault(r.lang, {}).setdefault(g, 0)
                counts[r.lang][g] += 1
    kept = {k: {g for g, n in v.items() if n >= language.SHARE * sum(v.values())} for k, v in counts.items()}
    text = "kalo ver eauoi unbekannt"
    gram, _ = language.grams_of(*text_column(pa.array([text])))
    n, held = filters.counts(*text_column(pa.array([text])))
    assert n[0] == len(gram)
    for i, lang in enumerate(filters.languages):
        assert held[0, i] == pytest.approx(sum(g in kept[lang] for g in gram.tolist()), abs=0.5)


def test_more_than_64_languages(spark):
    rows = [(4 * i, f"{chr(97 + i // 26)}{chr(97 + i % 26)}qx " * 20, f"l{i:02}") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify(docs, language.learn(docs)).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows if not held_out(i))


def test_edges(edge, empty, filters):
    rows = language.identify(edge, filters).collect()
    assert len(rows) == edge.count()
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {3, 4, 5, 6, None} >= und >= {3, 4, 5, 6} and all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert language.identify(empty, filters).count() == 0
    nothing = language.learn(empty)
    assert {r.lang_pred for r in language.identify(edge, nothing).collect()} == {"und"}
    assert np.all(nothing.slices == 0)


def test_memory_stays_near_that_of_the_batch(filters):
    """Temporary arrays follow a slice, not the batch of texts that a task holds."""
    rng = random.Random(6)
    words = ["".join(rng.choice(SYLLABLES["xx"]) for _ in range(3)) for _ in range(500)]
    column = pa.array([" ".join(rng.choices(words, k=600)) for _ in range(4000)])
    peaks = []
    for work in (lambda: language._judge(column, filters), lambda: list(language._learn(iter([pa.record_batch([pa.array(["xx"] * len(column)), column], names=["lang", "text"])])))):
        tracemalloc.start()
        work()
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert column.nbytes > 16e6 and max(peaks) < 3 * column.nbytes, peaks
