"""Phrase collocations of every language, by counting adjacent items in tiles.

A text is split into pieces at punctuation and line ends, and pieces into words.
Phrases grow by recursion: an item is a word at first, and two neighbouring items
of ``L`` words overlap in a phrase of ``L + 1``. A phrase can be frequent only where
both of its items are, so each round counts pairs of frequent items, and the
frequent pairs, ranked anew, are the items of the next.

* **Ranks.** The ``RANKED`` most frequent items of a round get their rank as
  number; their keys, 64 bits of language and words, are broadcast (2 MB).
* **Tiles.** The plane of two ranks is cut into tiles of ``SIDE`` by ``SIDE`` cells, so
  a pair of items has an address: tile and cell. Reading tasks count the pairs
  of the first ``HOT`` ranks in one dense array by bincount, and all others in
  sorted coordinate lists; both are moved as packed lists by tile. The task that
  owns a tile adds long lists to a dense array of its cells by bincount, and
  merges short ones in sorted order.
* **The rest.** Pairs with an item beyond the ranks have no address. They are
  counted by their keys in sorted coordinate lists alone, after a Bloom filter (16 MB
  at most) of the frequent items beyond the ranks; a join drops what passes it
  wrongly. So no item and no pair is left out.

A task sums what it reads before anything is moved. Candidates keep the counts of
all their first and last words, so every cut is at hand without another join.

Cases: NULL is the empty text, a NULL language is ``und``; texts without words give
nothing; repeated rows count each; an empty table gives an empty result. Should two
frequent words share a key, the job fails rather than merges them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reckoner.llm import bitfilter, tally
from reckoner.llm.bytewords import LOWER, mix, slices, text_column, words_of
from reckoner.llm.shared import ship, written

LEAST, LONGEST, WITHIN, TOP = 10, 3, 50, 2000
RANKED = 1 << 18
SIDE_BITS = 8
SIDE = 1 << SIDE_BITS
CELLS = SIDE * SIDE
HOT = 1 << 10
# Buckets grow with the corpus, so that the distinct pairs of one fit a task.
BUCKETS, MOST_BUCKETS, WORDS_A_BUCKET = 1024, 1 << 30, 1 << 21
DENSE_FROM = CELLS // 32
SHRINK = 4
KNOWN_AT = 500_000
U64 = np.uint64

# The bytes that end a piece, and those that end a word within one.
PIECE_END = np.array([b in b".,;:!?" or 0x0A <= b <= 0x0D for b in range(256)])
WORD = np.array([not (b in b" \t" or PIECE_END[b]) for b in range(256)])


def combined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The key of two neighbouring items."""
    return mix(mix(first + U64(0x9E3779B97F4A7C15)) * U64(3) + second)


def sliced_words(batch: pa.RecordBatch, text: int, lang_key: int) -> Iterator[tuple]:
    """For each slice: first row, words, their keys, and whether the next word is of the same piece."""
    langs = batch.column(lang_key).to_numpy().view(U64)
    for first, _, data, offsets in slices(*text_column(batch.column(text))):
        low = LOWER[data]
        words = words_of(low, offsets, WORD)
        keys = mix(words.hashes() + mix(langs[first + words.doc]))
        ends = np.r_[0, np.cumsum(PIECE_END[low])]
        piece = ends[words.start]
        joined = np.zeros(len(words), bool)
        joined[:-1] = (piece[1:] == piece[:-1]) & (words.doc[1:] == words.doc[:-1])
        yield first, words, keys, joined


def items(keys: np.ndarray, joined: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the items of ``length`` words that start at each word, and whether the next one starts in the same phrase."""
    for _ in range(length - 1):
        keys = np.r_[combined(keys[:-1], keys[1:]), keys[-1:]]
        joined = joined & np.r_[joined[1:], False]
    return keys, joined


# --- words

WORDS = "key long, lang string, word string, n long"


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, counts = {}, tally.Tally()

    def told() -> pa.RecordBatch:
        keys, n = counts.compact()
        named = [known[k] for k in keys.tolist()]
        columns = [pa.array(keys.view(np.int64)), pa.array([x[0] for x in named], pa.string()), pa.array([x[1] for x in named], pa.string()), pa.array(n)]
        return pa.record_batch(columns, names=["key", "lang", "word", "n"])

    for batch in batches:
        langs = batch.column(1).to_pylist()
        for first, words, keys, _ in sliced_words(batch, 0, 2):
            found, at, n = np.unique(keys, return_index=True, return_counts=True)
            counts.add(found, n)
            data = words.data.tobytes()
            for key, i in zip(found.tolist(), at.tolist(), strict=True):
                if key not in known:
                    known[key] = langs[first + words.doc[i]], data[words.start[i] : words.end[i]].decode()
            if len(known) > KNOWN_AT:
                yield told()
                known, counts = {}, tally.Tally()
    yield told()


# --- pairs of neighbouring items


class Items:
    """The frequent items of a round: ranks of the most frequent, a filter for the others."""

    def __init__(self, keys: np.ndarray, rest: np.ndarray | None):
        self.by_rank, self.rest = keys, rest
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Rank, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.searchsorted(self.keys, keys).clip(max=len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], -1)


def address(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Tile and cell of two ranks."""
    tile = (first >> SIDE_BITS) * (RANKED >> SIDE_BITS) + (second >> SIDE_BITS)
    return ((tile << (2 * SIDE_BITS)) | ((first & (SIDE - 1)) << SIDE_BITS) | (second & (SIDE - 1))).astype(U64)


def ranks_at(address_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code = address_.astype(np.int64)
    tile, cell = code >> (2 * SIDE_BITS), code & (CELLS - 1)
    across = RANKED >> SIDE_BITS
    return (tile // across << SIDE_BITS) | (cell >> SIDE_BITS), (tile % across << SIDE_BITS) | (cell & (SIDE - 1))


def tile_bucket(addresses: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(addresses >> U64(2 * SIDE_BITS)) % U64(buckets)).astype(np.int32)


PAIRS = "bucket int, keys binary, counts binary, second binary"


def _packed(parts: Iterator, coordinates: bool = False) -> pa.RecordBatch:
    """Rows of tiles, or of pairs beyond the ranks, whose bucket numbers are negative."""
    columns = [[], [], [], []]
    for bucket, keys, counts, *second in parts:
        packed = (keys.tobytes(), b"\x08" + counts.tobytes()) if coordinates else tally.pack(keys, counts)
        for column, value in zip(columns, (-1 - bucket if coordinates else bucket, *packed, second[0].tobytes() if coordinates else None), strict=True):
            column.append(value)
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*tally.NAMES, "second"])


class Coordinates:
    """Pairs of keys with counts, merged in the order of their combined key."""

    def __init__(self):
        self.parts, self.pending, self.held = [], 0, 0

    def add(self, first: np.ndarray, second: np.ndarray, n: np.ndarray | None = None) -> None:
        both = combined(first, second)
        if n is None:
            both, at, n = np.unique(both, return_index=True, return_counts=True)
            first, second = first[at], second[at]
        self.parts.append((both, first, second, n))
        self.pending += len(both)
        if self.pending > max(tally.COMPACT_AT, self.held):
            self.compact()

    def compact(self) -> None:
        both, first, second, n = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(both)
        start = np.flatnonzero(np.r_[True, np.diff(both[order]) != 0]) if len(both) else order
        at = order[start]
        n = np.add.reduceat(n[order], start) if len(both) else n
        self.parts, self.pending, self.held = [(both[at], first[at], second[at], n)], 0, len(at)

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs, which are held no more: first, second, count."""
        if not self.parts:
            return np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int64)
        self.compact()
        _, *found = self.parts[0]
        self.parts, self.held = [], 0
        return found

    def split(self, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """All pairs by bucket: first, count, second."""
        first, second, n = self.take()
        bucket = (mix(combined(first, second)) % U64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        found, start = np.unique(bucket[order], return_index=True)
        for b, at in zip(found.tolist(), np.split(order, start[1:]) if len(found) else [], strict=True):
            yield b, first[at], n[at], second[at]


def _count_pairs(batches: Iterator[pa.RecordBatch], frequent, length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    bucket_of = partial(tile_bucket, buckets=buckets)
    known, hot, tiles, rest = frequent.value, np.zeros(HOT * HOT, np.int64), tally.Tally(), Coordinates()
    for batch in batches:
        for _, _, keys, joined in sliced_words(batch, 0, 1):
            keys, joined = items(keys, joined, length)
            rank = known.find(keys)
            frequent_item = rank >= 0
            if known.rest is not None:
                beyond = np.flatnonzero(~frequent_item)
                frequent_item[beyond[bitfilter.may_hold(known.rest, mix(keys[beyond]))]] = True
            at = np.flatnonzero(joined[:-1] & frequent_item[:-1] & frequent_item[1:])
            first, second = rank[at], rank[at + 1]
            both = (first >= 0) & (second >= 0)
            dense = both & (first < HOT) & (second < HOT)
            hot += np.bincount(first[dense] * HOT + second[dense], minlength=HOT * HOT)
            tiles.add(address(first[both & ~dense], second[both & ~dense]))
            rest.add(keys[at[~both]], keys[at[~both] + 1])
            if tiles.held > tally.EMIT_AT:
                yield _packed(tally.split(*tiles.compact(), bucket_of))
                tiles = tally.Tally()
            if rest.held > tally.EMIT_AT:
                yield _packed(rest.split(buckets), coordinates=True)
    some = np.flatnonzero(hot)
    tiles.add(address(some // HOT, some % HOT), hot[some])
    yield _packed(tally.split(*tiles.compact(), bucket_of))
    yield _packed(rest.split(buckets), coordinates=True)


def tile_counts(rows: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Addresses and counts of one bucket: long lists of a tile by bincount, others merged in order."""
    grids, sparse = {}, tally.Tally()
    for addresses, counts in rows:
        tiles, first, size = np.unique(addresses >> U64(2 * SIDE_BITS), return_index=True, return_counts=True)
        short = np.ones(len(addresses), bool)
        for i in np.flatnonzero(size >= DENSE_FROM):
            at = slice(first[i], first[i] + size[i])
            cells = (addresses[at] & U64(CELLS - 1)).astype(np.int64)
            # Weights are added as doubles: exact below 2 ** 53.
            added = np.bincount(cells, weights=counts[at], minlength=CELLS).astype(np.int64)
            grids[tiles[i]] = grids[tiles[i]] + added if tiles[i] in grids else added
            short[at] = False
        sparse.add(addresses[short], counts[short])
    for tile, grid in grids.items():
        cells = np.flatnonzero(grid)
        sparse.add((tile << U64(2 * SIDE_BITS)) | cells.astype(U64), grid[cells])
    yield sparse.compact()


COUNTED = "key long, first long, second long, n long"


def _counted(first: np.ndarray, second: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    columns = [combined(first, second).view(np.int64), first.view(np.int64), second.view(np.int64), n]
    return pa.record_batch([pa.array(c) for c in columns], names=["key", "first", "second", "n"])


def coordinate_counts(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pairs = Coordinates()
    for keys, counts, second in rows:
        pairs.add(np.frombuffer(keys, U64), np.frombuffer(second, U64), tally.counts_of(counts))
    return pairs.take()


def _merge(batches: Iterator[pa.RecordBatch], frequent, least: int) -> Iterator[pa.RecordBatch]:
    """Frequent pairs of each bucket; rows of a bucket follow each other."""
    by_rank = frequent.value.by_rank

    def done(bucket: int | None, rows: list) -> Iterator[pa.RecordBatch]:
        if bucket is not None and bucket < 0:
            first, second, n = coordinate_counts(rows)
            keep = n >= least
            yield _counted(first[keep], second[keep], n[keep])
            return
        for addresses, counts in tile_counts(tally.unpack(keys, counts) for keys, counts, _ in rows):
            keep = counts >= least
            first, second = ranks_at(addresses[keep])
            yield _counted(by_rank[first], by_rank[second], counts[keep])

    bucket, rows = None, []
    for batch in batches:
        for b, *packed in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if b != bucket and rows:
                yield from done(bucket, rows)
                rows = []
            bucket = b
            rows.append(packed)
    yield from done(bucket, rows)


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.record_batch([pa.array(mix(batch.column(0).to_numpy().view(U64)).view(np.int64))], names=["hash"])


def ranked(frequent: DataFrame) -> Items:
    """``frequent``: key, n. The most frequent keys, at most ``RANKED``, reach the driver, and the filter of the others.

    How frequent is read off a histogram of counts in sixteenths of a power of two, some thousand rows at most.
    """
    level = F.floor(16 * F.log2("n"))
    histogram = sorted(map(tuple, frequent.groupBy(level.alias("level")).agg(F.count("*")).collect()), reverse=True)
    total, held, lowest = sum(n for _, n in histogram), 0, math.inf
    for at, n in histogram:
        held += n
        if held > RANKED:
            break
        lowest = at
    top = frequent.filter(level >= F.lit(lowest)).select("key", "n").toArrow()
    order = np.lexsort((top["key"].to_numpy(), -top["n"].to_numpy()))
    keys = top["key"].to_numpy()[order].view(U64)
    if len(keys) == total:
        return Items(keys, None)
    hashes = frequent.filter(level < F.lit(lowest)).select("key").mapInArrow(_mixed, "hash long")
    return Items(keys, bitfilter.build(hashes, "hash", bitfilter.log2_bits(total - len(keys))))


def frequent_pairs(texts: DataFrame, known: DataFrame, length: int, least: int, buckets: int) -> DataFrame:
    """Pairs of neighbouring items of ``length`` words: key, first, second, n. ``texts``: text, lang_key; ``known``: key, n."""
    spark = texts.sparkSession
    frequent = spark.sparkContext.broadcast(ranked(known))
    found = texts.mapInArrow(lambda b: _count_pairs(b, frequent, length, buckets), PAIRS)
    owned = found.repartition("bucket").sortWithinPartitions("bucket")
    pairs = written(owned.mapInArrow(lambda b: _merge(b, frequent, least), COUNTED), "pairs")
    frequent.destroy()
    # What only the filter let pass has an item that is not known.
    pairs = pairs.join(known.select(F.col("key").alias("first")), "first", "left_semi")
    return pairs.join(known.select(F.col("key").alias("second")), "second", "left_semi")


# --- phrases


def count_words(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts with the key of their language, and all words: key, lang, word, n."""
    ship(docs.sparkSession)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    texts = docs.select(F.col("text").cast("string").alias("text"), lang.alias("lang"), F.xxhash64(lang).alias("lang_key"))
    words = texts.mapInArrow(_count_words, WORDS).groupBy("lang", "word").agg(F.min("key").alias("key"), F.sum("n").alias("n"))
    return texts.select("text", "lang_key"), written(words, "words")


def phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases by length, from one word on, and the number of words of each language.

    Phrases: key, lang, phrase, last (word), first_n and last_n (counts of
    their first and last 1, 2, ... words), n, and first, second: the keys of
    the two phrases that they consist of.
    """
    texts, words = count_words(docs)
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = words.filter(F.col("n") >= least)
    if not frequent.groupBy("key").count().filter("count > 1").isEmpty():
        raise ValueError("two frequent words share a key")
    total = totals.agg(F.sum("total")).first()[0] or 0
    buckets = max(BUCKETS, min(MOST_BUCKETS, total // WORDS_A_BUCKET))
    no_key = F.lit(None).cast("long")
    tables = [
        frequent.select(
            "key", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), F.array("n").alias("first_n"), F.array("n").alias("last_n"),
            "n", no_key.alias("first"), no_key.alias("second"),
        )
    ]
    for length in range(1, longest):
        below = tables[-1]
        pairs = frequent_pairs(texts, below.select("key", "n"), length, least, buckets)
        a = below.select(F.col("key").alias("first"), "lang", "phrase", "first_n")
        b = below.select(F.col("key").alias("second"), "last", "last_n")
        met = pairs.join(a, "first").join(b, "second").select(
            "key", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last",
            F.concat("first_n", F.array("n")).alias("first_n"), F.concat("last_n", F.array("n")).alias("last_n"), "n", "first", "second",
        )
        tables.append(written(met, "phrases"))
    return tables, totals


def top_per_group(rows: DataFrame, group: str, order: list, k: int, spread: str) -> DataFrame:
    """The first ``k`` rows of each group with their ``rank``: a large group is reduced in shards, ever fewer, before it meets in one task."""
    shards, total = [1], rows.count()
    while total > k * SHRINK * shards[-1]:
        shards.append(shards[-1] * SHRINK)
    for n in reversed(shards):
        shard = F.pmod(F.xxhash64(spread), F.lit(n))
        ranked_rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(group, shard).orderBy(*order)))
        rows = ranked_rows.filter(F.col("rank") <= k)
        if n > 1:
            rows = rows.drop("rank")
    return rows


def cut(k: int, length: int) -> Column:
    """Score, k, l and r of a cut after ``k`` words. Exact: 38 digits hold counts up to 10 ** 16."""
    left, right = f"get(first_n, {k - 1})", f"get(last_n, {length - k - 1})"
    wide = "CAST({} AS DECIMAL(38,0))"
    score = f"({wide.format('n')} * {wide.format('n')} * {wide.format(1_000_000)}) DIV ({wide.format(left)} * {wide.format(right)})"
    return F.struct(F.expr(score).alias("score"), F.lit(k).alias("k"), F.expr(left).alias("l"), F.expr(right).alias("r"))


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, within: int = WITHIN, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score, n_words.

    A phrase is dropped where a longer one that holds it occurs ``within`` percent
    as often. Any longer one is at most as frequent as one longer by a word.
    """
    tables, totals = phrases(docs, longest, least)
    found = []
    for length in range(2, longest + 1):
        rows = tables[length - 1]
        if length < longest:
            longer = tables[length]
            inside = longer.select(F.col("first").alias("key"), F.col("n").alias("most")).unionAll(longer.select(F.col("second").alias("key"), F.col("n").alias("most")))
            rows = rows.join(inside.groupBy("key").agg(F.max("most").alias("most")), "key", "left")
            rows = rows.filter(F.coalesce(100 * F.col("most") < within * F.col("n"), F.lit(True)))
        least_cut = F.array_min(F.array(*[cut(k, length) for k in range(1, length)]))
        found.append(rows.withColumn("cut", least_cut).select("lang", "phrase", F.col("n").alias("a"), "cut.l", "cut.r", "cut.score", F.lit(length).alias("n_words")))
    candidates = written(reduce(DataFrame.unionAll, found), "candidates")
    best = top_per_group(candidates, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], top, "phrase")
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score", "n_words")
