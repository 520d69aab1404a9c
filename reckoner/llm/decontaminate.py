"""Benchmark decontamination by a prefix-filtered set join.

An item is cut into windows of ten consecutive words (an item of fewer words is
one window). A window is the set of its three-word shingles with their places.
A document holds a window only if it holds all shingles, so the necessary
prefix, in the order of rarity in the documents, is the one rarest shingle:
documents and windows are joined on it. Place and length bounds drop what
cannot fit, and the words around the shingle, carried with it, are compared
word for word. No text is shuffled.

Two passes read the documents. The first counts the shingles of the benchmark,
the second finds the places of the rarest. Both look at shingles through a
Bloom filter of at most 16 MB; the exact tests are shuffled joins, so neither
benchmark nor corpus has to fit anywhere. Hot shingles are summed before their
shuffle, and the join on places is a plain one, which adaptive execution
splits.

Cases: NULL and texts without words have no hits and no words. Repeated rows
and rows that share an id are judged each on its own. An item without words, or
a NULL item, is in no document. Items that share a text all count; rows that
share an ``item_id`` count as one item. An ``item_id`` may be of any type and
is carried as text; the words of an item whose id is NULL are hit, but it is
not among the items.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckoner.llm import bitfilter
from reckoner.llm.bytewords import ALPHANUMERIC, LOWER, run_hashes, slices, text_column, words_of
from reckoner.llm.shared import ship, written

WINDOW = 10
SHINGLE = 3
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

WINDOWS = "item_id string, words array<binary>, shingles array<long>"
PLACES = "text_key long, n_words long, places array<struct<shingle:long,place:int,left:int,words:array<binary>>>"


def _hashes_of(words: list[bytes]) -> np.ndarray:
    """Hashes of the shingles of one window; of all its words if it has fewer than three."""
    data, offsets = text_column(pa.array([b" ".join(words).decode("utf-8", "surrogatepass")]))
    found = words_of(data, offsets, ALPHANUMERIC)
    return run_hashes(found.hashes(), min(SHINGLE, len(words)))


def _windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, words, shingles = [], [], []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            all_words = WORD.findall((text or "").encode().translate(bytes(LOWER)))
            for i in range(max(1, len(all_words) - size + 1) if all_words else 0):
                window = all_words[i : i + size]
                ids.append(item)
                words.append(window)
                shingles.append(_hashes_of(window).view(np.int64).tolist())
        yield pa.record_batch(
            [pa.array(ids, pa.string()), pa.array(words, pa.list_(pa.binary())), pa.array(shingles, pa.list_(pa.int64()))],
            names=["item_id", "words", "shingles"],
        )


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per distinct window: its words, the hashes of its shingles in order, and its items."""
    rows = items.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    windows = rows.mapInArrow(lambda batches: _windows(batches, size), WINDOWS)
    return windows.groupBy("words", "shingles").agg(F.collect_set("item_id").alias("items"))


def _matches(words, table: np.ndarray, sizes: list[int]):
    """Shingle length, first word and hash of every shingle that may be in the filter."""
    hashes = words.hashes()
    for k in sizes:
        runs = run_hashes(hashes, k)
        at = bitfilter.may_hold(table, runs)
        at = at[words.doc[at] == words.doc[at + k - 1]]
        yield k, at, runs[at]


def _count(batches: Iterator[pa.RecordBatch], table, sizes) -> Iterator[pa.RecordBatch]:
    """Hash and number of the documents' shingles that may be of the benchmark."""
    for batch in batches:
        found = []
        for _, _, data, offsets in slices(*text_column(batch.column(0))):
            words = words_of(LOWER[data], offsets, ALPHANUMERIC)
            found += [h for _, _, h in _matches(words, table.value, sizes)]
        values, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
        yield pa.record_batch([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], names=["shingle", "n"])


def _places(batches: Iterator[pa.RecordBatch], table, sizes, reach: int) -> Iterator[pa.RecordBatch]:
    """One row per document, with the places of shingles that may be a prefix and the words around them."""
    kind = pa.list_(
        pa.struct([("shingle", pa.int64()), ("place", pa.int32()), ("left", pa.int32()), ("words", pa.list_(pa.binary()))])
    )
    for batch in batches:
        data, offsets = text_column(batch.column(2))
        numbers, places = np.zeros(len(batch), np.int64), [[] for _ in range(len(batch))]
        for first, end, part, own in slices(data, offsets):
            words = words_of(LOWER[part], own, ALPHANUMERIC)
            numbers[first:end] = words.n_words
            text = words.data.tobytes()
            for _, at, hashes in _matches(words, table.value, sizes):
                for i, h in zip(at.tolist(), hashes.view(np.int64).tolist(), strict=True):
                    doc = words.doc[i]
                    start = int(words.first[doc])
                    low, high = max(start, i - reach + 1), min(start + int(words.n_words[doc]), i + reach)
                    around = [text[words.start[j] : words.end[j]] for j in range(low, high)]
                    places[first + doc].append({"shingle": h, "place": i - start, "left": i - low, "words": around})
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(numbers), pa.array(places, kind)],
            names=["doc_id", "text_key", "n_words", "places"],
        )


def decontaminate(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: words, hit words, and the items of which a window occurs.

    Columns: row_id, doc_id, text_key, n_words, n_hit, items (sorted as text).
    ``row_id`` numbers the rows; equal ``doc_id`` are kept apart by it.
    ``text_key`` is a hash of the text, to find the row again.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    windows = written(item_windows(items, size), "windows")
    shingles = windows.select(F.explode("shingles").alias("shingle")).distinct()
    sizes = [r[0] for r in windows.select(F.least(F.size("words"), F.lit(SHINGLE)).alias("k")).distinct().collect()]
    bits = bitfilter.log2_bits(shingles.count())

    every = spark.sparkContext.broadcast(bitfilter.build(shingles, "shingle", bits))
    counts = texts.select("text").mapInArrow(lambda b: _count(b, every, sizes), "shingle long, n long")
    counts = counts.groupBy("shingle").agg(F.sum("n").alias("n"))
    places = windows.select("words", "items", F.posexplode("shingles").alias("offset", "shingle"))
    ranked = places.join(counts, "shingle", "left").groupBy("words").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("rarest"),
        F.first("items").alias("items"),
    )
    prefixes = written(
        ranked.filter(F.col("rarest.n") > 0).select("rarest.shingle", "rarest.offset", "words", "items"), "prefixes"
    )

    needed = prefixes.select("shingle").distinct()
    rare = spark.sparkContext.broadcast(bitfilter.build(needed, "shingle", bits))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = texts.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        lambda b: _places(b, rare, sizes, size), f"doc_id {kind}, {PLACES}"
    )
    found = written(found.withColumn("row_id", F.monotonically_increasing_id()), "places")

    places = found.select("row_id", "n_words", F.explode("places").alias("at")).select("row_id", "n_words", "at.*")
    length = F.size("item_words")
    joined = places.join(prefixes.withColumnRenamed("words", "item_words"), "shingle")
    fitting = joined.filter((F.col("place") >= F.col("offset")) & (F.col("place") - F.col("offset") + length <= F.col("n_words")))
    hits = fitting.filter(F.slice("words", F.col("left") - F.col("offset") + 1, length) == F.col("item_words")).select(
        "row_id", "items", (F.col("place") - F.col("offset")).alias("start"), length.alias("length")
    )
    hits = written(hits, "hits")

    covered = hits.select("row_id", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("word"))
    n_hit = covered.distinct().groupBy("row_id").agg(F.count("*").alias("n_hit"))
    of_row = hits.select("row_id", F.explode("items").alias("item")).distinct()
    of_row = of_row.groupBy("row_id").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return (
        found.select("row_id", "doc_id", "text_key", "n_words")
        .join(n_hit.join(of_row, "row_id", "left"), "row_id", "left")
        .select(
            "row_id", "doc_id", "text_key", "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def digest(found: DataFrame) -> DataFrame:
    """The items of each document as their number and one digest."""
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
