import duckdb
import pytest

import corpus_pipeline
from checks.compare import connect
from reckoner.llm.queries import QUERIES
from reckoner.llm.sql import SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = connect(SF).execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(str(tuple(r[names.index(c)] for c in columns)) for r in cursor.fetchall())
    assert sorted(str(tuple(r)) for r in df.select(*columns).collect()) == want


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "mixing"]


def test_stages_on_edges(spark, edge, empty):
    """Each stage by what it must drop and keep; all but the last return the columns they got."""
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted(str(r.doc_id) for r in df.select("doc_id").collect())
    kept = stages["language_id"](spark, edge, SF)
    assert kept.columns == edge.columns and not {"3", "4", "5", "6"} & set(ids(kept)) and "100" in ids(kept)
    assert "8" in ids(kept)  # a letter, but too short for an n-gram: nothing speaks against it
    for name in ("exact_dedup", "near_dedup"):
        kept = stages[name](spark, edge, SF)
        assert kept.columns == edge.columns and ids(kept).count("1") == 1 and "2" not in ids(kept) and "7" in ids(kept)
    assert ids(stages["decontamination"](spark, edge, SF)) == ids(edge)
    mixed = stages["mixing"](spark, edge, SF)
    assert mixed.columns == [*edge.columns, "copy"] and 0 < mixed.count() and mixed.filter("copy > 3").isEmpty()
    for name, stage in stages.items():
        assert stage(spark, empty, SF).count() == 0, name


def test_contaminated_documents_go(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    docs = spark.createDataFrame([(1, "clean words only"), (2, f"before {item} after"), (2, "same id, clean")], "doc_id long, text string")
    kept = corpus_pipeline.drop_contaminated(spark, docs, SF).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, "clean words only"), (2, "same id, clean")]


def test_run(spark):
    docs = f"'{SF}/documents.parquet'"
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy"]
    known = {r[0] for r in duckdb.sql(f"SELECT doc_id FROM {docs}").fetchall()}
    rows = out.select("doc_id", "copy").collect()
    assert {r.doc_id for r in rows} <= known and len(rows) == len({(r.doc_id, r.copy) for r in rows})
