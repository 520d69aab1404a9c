import random
from collections import defaultdict

import pytest
from helpers import rows

from reckoner.operators.aggregate import mean_count
from reckoner.operators.partials import Partials

KEYS = ["movie_id", "year"]
SCHEMA = "movie_id long, year int, total double"


def batch(spark, seed, n=200):
    rng = random.Random(seed)
    data = [(rng.choice([None, *range(20)]), rng.choice([2020, 2021]), rng.choice([None, 1.0, 2.5, 4.0])) for _ in range(n)]
    return spark.createDataFrame(data, "movie_id long, year int, rating double")


def state(spark, tmp_path):
    return Partials(spark, f"file://{tmp_path}/state", KEYS, "rating", SCHEMA)


def means(df):
    return sorted(rows(df), key=str)


def whole(*parts):
    every = parts[0]
    for p in parts[1:]:
        every = every.unionAll(p)
    return means(mean_count(every, KEYS, "rating", "mean", "n").filter("n > 0"))


def test_merged_state_equals_all_files(spark, tmp_path):
    """Batches added one by one, one of them twice, one replaced; names that a path must escape."""
    kept, (a, b, c) = state(spark, tmp_path), (batch(spark, i) for i in range(3))
    assert means(kept.means("mean", "n")) == []
    kept.add(a, "day=1/a b")
    kept.add(b, "b")
    kept.add(a, "day=1/a b")
    assert means(kept.means("mean", "n")) == whole(a, b)
    kept.add(c, "b")
    assert means(state(spark, tmp_path).means("mean", "n")) == whole(a, c)


def test_adding_reads_no_other_batch(spark, tmp_path):
    kept = state(spark, tmp_path)
    kept.add(batch(spark, 0), "a")
    before = sorted(str(p) for p in (tmp_path / "state" / "batch=a").iterdir())
    kept.add(batch(spark, 1), "b")
    assert sorted(str(p) for p in (tmp_path / "state" / "batch=a").iterdir()) == before
    per_key = defaultdict(int)
    for r in kept.rows().filter("votes > 0").collect():
        per_key[r.batch, r.movie_id, r.year] += 1
    assert set(per_key.values()) == {1}


def test_a_batch_that_lost_its_rows_replaces_them(spark, tmp_path):
    kept, a = state(spark, tmp_path), batch(spark, 0)
    kept.add(a, "a")
    kept.add(a, "b")
    kept.add(a.limit(0), "b")
    assert means(kept.means("mean", "n")) == whole(a)


def test_fold_keeps_means_and_refuses_folded_batches(spark, tmp_path):
    kept, (a, b, c) = state(spark, tmp_path), (batch(spark, i) for i in range(3))
    for name, df in (("a", a), ("b", b), ("c", c)):
        kept.add(df, name)
    kept.fold(["a", "b"], "ab")
    assert means(kept.means("mean", "n")) == whole(a, b, c)
    assert {r.batch for r in kept.rows().select("batch").distinct().collect()} == {"ab", "c"}
    with pytest.raises(ValueError, match="was folded"):
        kept.add(a, "a")
    kept.fold(["a", "b"], "ab")  # again, as after a failure
    assert means(kept.means("mean", "n")) == whole(a, b, c)


def test_a_fold_that_failed_before_removing_counts_once(spark, tmp_path, monkeypatch):
    kept, (a, b) = state(spark, tmp_path), (batch(spark, i) for i in range(2))
    kept.add(a, "a")
    kept.add(b, "b")
    monkeypatch.setattr("reckoner.operators.partials._escaped", lambda spark, batch: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        kept.fold(["a", "b"], "ab")
    assert len({r.batch for r in kept.rows().collect()}) == 3
    assert means(kept.means("mean", "n")) == whole(a, b)
    monkeypatch.undo()
    kept.fold(["a", "b"], "ab")
    assert means(kept.means("mean", "n")) == whole(a, b)


def test_names_are_checked(spark, tmp_path):
    kept = state(spark, tmp_path)
    for name in ("", "a\x1fb"):
        with pytest.raises(ValueError, match="batch name"):
            kept.add(batch(spark, 0), name)
    with pytest.raises(ValueError, match="of its own"):
        kept.fold(["a"], "a")
    with pytest.raises(ValueError, match="schema must name"):
        Partials(spark, str(tmp_path), KEYS, "rating", "movie_id long, total double")
