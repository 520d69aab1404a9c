"""Exact deduplication with an extendible-hash index on shared files.

Texts are equal when identical after every run of white space is one blank.
A 64-bit hash of that text is its key. The index holds one chain per key, with
an entry for each text: digest, the row that stays, and the number of rows.

* **Directory.** Keys are counted per prefix. A bucket of more than
  ``capacity`` keys is overfull; the directory doubles, and only overfull
  buckets are split by one more bit, until none is left. The directory has two
  to the global depth slots, each naming its bucket.
* **Owners.** Buckets are contiguous ranges of keys. Each task owns a range of
  buckets, links the entries of a key to a chain and writes its part of the
  index to the shared folder.
* **Bytes.** Texts whose key occurs more than once are compared byte by byte,
  as the grouping key of an aggregate: copies meet in the tasks that read them,
  so a hot group moves one text per task. Rows are looked up by key and digest;
  should two texts share both, the job fails rather than merges them.

Rows enter counts before any shuffle, and rows join the written index by a
plain join, so no group is gathered. Only built-in functions are used.

Cases: NULL counts as empty, and all empty texts are one group. Of equal texts
the row with the smallest ``doc_id`` stays (NULL ids last); of repeated rows
with that id exactly one. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reckoner.llm.shared import written

CAPACITY = 1 << 16
# A run of blanks that is not already one space.
RUNS = r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), RUNS, " ")


def hash_key(text: Column) -> Column:
    return F.xxhash64(text)


def prefix(key: Column, depth: int) -> Column:
    """The first ``depth`` bits of a key."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """Slot to bucket, and the global depth. ``keys`` holds each ``key`` once."""
    depth = max(0, math.ceil(math.log2(max(1, keys.count()) / capacity)))
    leaves, rest = [], keys
    while True:
        counted = rest.groupBy(prefix(F.col("key"), depth).alias("prefix")).agg(F.count("*").alias("n"))
        counted = written(counted, "directory")
        leaves.append((depth, counted.filter(F.col("n") <= capacity).select("prefix")))
        full = counted.filter(F.col("n") > capacity).select("prefix")
        if full.isEmpty():
            break
        rest = rest.withColumn("prefix", prefix(F.col("key"), depth)).join(full, "prefix", "left_semi").select("key")
        depth += 1
    slots = []
    for local, buckets in leaves:
        first = F.shiftleft("prefix", depth - local)
        of_bucket = F.sequence(first, first + F.lit((1 << (depth - local)) - 1).cast("long"))
        slots.append(buckets.select(F.explode(of_bucket).alias("slot"), first.alias("bucket")))
    out = slots[0]
    for more in slots[1:]:
        out = out.unionAll(more)
    return out, depth


def build_index(docs: DataFrame, rows: DataFrame, capacity: int, key) -> DataFrame:
    """The index: bucket, key, and its chain of (digest, keeper, size)."""
    entries = written(
        rows.groupBy("key", "digest").agg(
            F.min(F.struct(F.isnull("doc_id").alias("unknown"), "doc_id", "row_id")).alias("keeper"),
            F.count("*").alias("size"),
        ),
        "entries",
    )
    keys = entries.groupBy("key").agg(F.sum("size").alias("rows"))
    slots, depth = directory(keys.select("key"), capacity)

    repeated = keys.filter(F.col("rows") > 1).select("key")
    texts = docs.select(normalised(F.col("text")).alias("norm")).withColumn("key", key(F.col("norm")))
    # Grouped by the text alone, so that the join on keys may be split and copies are summed before they meet.
    texts = texts.join(repeated, "key", "left_semi").groupBy("norm").agg(F.min("key").alias("key"), F.count("*").alias("rows"))
    texts = texts.select("key", F.sha2(F.col("norm").cast("binary"), 256).alias("digest"), "rows")
    compared = texts.groupBy("key", "digest").agg(F.sum("rows").alias("rows"), F.count("*").alias("texts"))

    differ = F.raise_error(F.concat(F.lit("different texts share key and digest "), F.col("digest")))
    one_text = F.coalesce(F.col("texts"), F.lit(1)) == 1
    same_rows = F.coalesce(F.col("rows"), F.lit(1)) == F.col("size")
    checked = entries.join(compared, ["key", "digest"], "left").select(
        "key", "digest", "keeper", F.when(one_text & same_rows, F.col("size")).otherwise(differ).alias("size")
    )
    owned = checked.withColumn("slot", prefix(F.col("key"), depth)).join(slots, "slot").repartitionByRange("bucket", "key")
    chains = owned.groupBy("bucket", "key").agg(
        F.sort_array(F.collect_list(F.struct("digest", "keeper", "size"))).alias("chain")
    )
    return written(chains, "index")


def exact_dedup(docs: DataFrame, capacity: int = CAPACITY, key=hash_key) -> DataFrame:
    """Per row of ``docs``: row_id, doc_id, text_key, keep_id, group_size, kept, text_sha256.

    ``row_id`` numbers the rows of this result, ``text_key`` is a hash of the
    text, to find the row again. ``key`` hashes a normalised text to a long.
    """
    norm = normalised(F.col("text"))
    rows = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("text_key"), norm.alias("norm")).select(
        "doc_id", "text_key", key(F.col("norm")).alias("key"), F.sha2(F.col("norm").cast("binary"), 256).alias("digest")
    )
    rows = written(rows.withColumn("row_id", F.monotonically_increasing_id()), "rows")
    index = build_index(docs, rows, capacity, key)
    found = rows.join(index.select("key", "chain"), "key").select(
        "row_id", "doc_id", "text_key", "digest", F.get(F.filter("chain", lambda e: e["digest"] == F.col("digest")), F.lit(0)).alias("e")
    )
    return found.select(
        "row_id", "doc_id", "text_key",
        F.col("e.keeper.doc_id").alias("keep_id"),
        F.col("e.size").alias("group_size"),
        (F.col("e.keeper.row_id") == F.col("row_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
