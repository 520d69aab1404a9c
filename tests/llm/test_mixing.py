import random
import re
from collections import defaultdict

import pytest

from reckoner.llm import mixing


def brute_targets(sizes):
    """Sources in code point order, weights repeating, excess reshared until none is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        share = (total - sum(fixed.values())) / max(1, sum(weight[s] for s in free))
        above = [s for s in free if weight[s] * share >= 3 * sizes[s]]
        if not above:
            return fixed | {s: weight[s] * share for s in free}
        fixed |= {s: 3.0 * sizes[s] for s in above}


def check(df, tolerance):
    rows = df.collect()
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 3 * r.size
    want = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= tolerance * largest[s] + 1e-6
    return rows


def test_edges(edge):
    rows = check(mixing.mix(edge), 1)
    assert len(rows) == edge.count()
    want = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in edge.collect() if r.doc_id not in (None, 9)}
    assert all(r.size == want[r.doc_id] for r in rows if r.doc_id in want)


@pytest.fixture(scope="module")
def uneven(spark):
    """A source with a third of all rows, tiny sources at their limit, and a source without words."""
    rng = random.Random(1)
    rows = [(i, " ".join("w" * rng.randrange(1, 60)), "hot" if i % 3 else f"s{i % 17}") for i in range(3000)]
    rows += [(5000, "one", "tiny"), (5001, "", "void"), (5002, "two words", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7).cache()


def test_targets_are_met_within_half_a_document(uneven):
    check(mixing.mix(uneven), 0.5)


def test_reruns_agree_whatever_the_partitions(uneven):
    one = sorted(map(tuple, mixing.mix(uneven).collect()), key=str)
    assert one == sorted(map(tuple, mixing.mix(uneven.repartition(2)).collect()), key=str)


def test_expectations_hold_over_seeds(spark, monkeypatch):
    """Each document is taken as often, on average, as its rate says."""
    docs = spark.createDataFrame([(i, " ".join("w" * (1 + i % 5)), "ab"[i % 2]) for i in range(200)], "doc_id long, text string, source string")
    counts, rounds = defaultdict(int), 4
    for seed in range(rounds):
        monkeypatch.setattr(mixing, "SEED", seed)
        rows = mixing.mix(docs).collect()
        for r in rows:
            counts[r.source] += r.copies
    rate = {r.source: r.target / r.source_size for r in rows}
    for source, n in counts.items():
        assert n / rounds / 100 == pytest.approx(rate[source], abs=0.04)


def test_rows_of_the_mix(edge):
    taken = mixing.copies_of_rows(edge)
    assert set(taken.columns) == {*edge.columns, "copies"}
    want = sorted((str(r.doc_id), r.copies) for r in mixing.mix(edge).filter("copies > 0").collect())
    assert sorted((str(r.doc_id), r.copies) for r in taken.collect()) == want


def test_empty_table(empty):
    assert mixing.mix(empty).count() == 0 and mixing.copies_of_rows(empty).count() == 0
