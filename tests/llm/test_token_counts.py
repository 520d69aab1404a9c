import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reckoner.llm import token_counts
from reckoner.llm.shared import new_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_pieces_add_up(library):
    rng = random.Random(3)
    parts = ["a", " ", "  ", "\n", "\t", "1", "'s", "é", "　", " ", "\u0085", "\x1c", "<|endoftext|>", "​", "!?", "B", "日本", "😀"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(2000)]
    assert token_counts.PieceCounter(PATH).counts(texts) == [library(t) for t in texts]


def test_edges(spark, edge, library):
    got = token_counts.count_tokens(edge, PATH, new_folder(spark, "cache")).collect()
    want = [(r[0], len((r[1] or "").encode()), library(r[1])) for r in edge.select("doc_id", "text").collect()]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)


def test_only_distinct_misses_are_encoded_and_appended(spark, edge):
    cache = new_folder(spark, "cache")
    version = token_counts.version_of(PATH)
    stored = lambda: spark.read.parquet(f"{cache}/version={version}")
    half = edge.filter("doc_id < 10")
    token_counts.count_tokens(half, PATH, cache)
    before = stored().count()
    assert before == half.selectExpr("coalesce(text, '') AS text").distinct().count()
    token_counts.count_tokens(edge, PATH, cache)
    assert stored().count() == stored().select("digest").distinct().count() == edge.selectExpr("coalesce(text, '') AS text").distinct().count()
    files = set(stored().inputFiles())
    token_counts.count_tokens(edge, PATH, cache)
    assert stored().count() == edge.selectExpr("coalesce(text, '') AS text").distinct().count() and files <= set(stored().inputFiles())


def test_stored_counts_are_used(spark):
    cache, docs = new_folder(spark, "cache"), spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    digest = docs.selectExpr("unhex(sha2(text, 256)) AS digest", "99L AS n_tokens")
    digest.write.parquet(f"{cache}/version={token_counts.version_of(PATH)}")
    assert token_counts.count_tokens(docs, PATH, cache).first()["n_tokens"] == 99


def test_empty_table(spark, empty):
    assert token_counts.count_tokens(empty, PATH, new_folder(spark, "cache")).count() == 0
