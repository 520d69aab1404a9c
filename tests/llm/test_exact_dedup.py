import re
from collections import defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from reckoner.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    order = lambda i: (i is None, i or 0)
    out = []
    for text, ids in groups.items():
        ids.sort(key=order)
        for nth, i in enumerate(ids):
            out.append((i, ids[0], len(ids), nth == 0, sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_edges(edge):
    rows = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    assert result(exact_dedup.exact_dedup(edge)) == brute(rows)


def test_buckets_split_and_colliding_keys_are_chained(spark):
    """Eight keys for 300 texts: chains of many texts, and a directory that must double."""
    rows = [(i, f"text {i % 300}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    weak = lambda t: F.shiftleft(F.xxhash64(t).bitwiseAND(F.lit(7)), 61)
    assert result(exact_dedup.exact_dedup(docs, capacity=2, key=weak)) == brute(rows)


def test_directory_covers_every_key_once(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("key"))
    slots, depth = exact_dedup.directory(keys, 100)
    assert sorted(r[0] for r in slots.select("slot").collect()) == list(range(1 << depth))
    sizes = keys.withColumn("slot", exact_dedup.prefix(F.col("key"), depth)).join(slots, "slot").groupBy("bucket").count()
    assert sizes.agg(F.sum("count"), F.max("count") <= 100).first() == (3000, True)


def test_different_texts_of_one_digest_fail(spark, monkeypatch):
    """Were two texts to share key and digest, the job stops."""
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.concat(F.lit("same"), F.left(c.cast("string"), F.lit(0))))
    try:
        exact_dedup.exact_dedup(docs, key=lambda t: F.length(t).cast("long")).collect()
    except Exception as error:
        assert "different texts share key and digest" in str(error)
    else:
        raise AssertionError("merged")


def test_empty_table(empty):
    assert exact_dedup.exact_dedup(empty).count() == 0
