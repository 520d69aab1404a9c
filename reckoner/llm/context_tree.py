"""Language-model scoring by context-tree weighting over bytes.

What is scored is the text as its tokens: lower-cased words, a blank between
two, and an end mark. A byte is eight binary decisions. Each decision has a tree of contexts, the
preceding bytes from the most recent on, up to ``DEPTH``. A node estimates its
bit by Krichevsky-Trofimov from all training bytes seen in its context, and the
estimates of all depths are mixed by the tree's weights: a node's own estimate
and the product of its children, a half each. The code length of a text is the
sum of the mixture's over its bytes and one end mark.

A context is kept from ``LEAST`` occurrences on, so what is learned grows with
the corpus. The bytes of a kept context that come in no kept deeper one are one
child together, its rest; a context with no kept deeper one is all rest, which
makes it a leaf. A binary node that no count touches has probability one half
from there on, so only touched ones are held.

The tree is never in one place. Its counts are a table in buckets by the
``SPLIT`` most recent bytes, more buckets for more input. Each bucket is
weighted by its own task; the contexts shorter than ``SPLIT`` need of it only
sums by binary node, which one aggregate adds up. These shorter contexts, at
most 2 ** (8 * SPLIT) binary nodes whatever the input, are broadcast. To
score, documents are laid in parts of some ``PART_BYTES``; a part asks the
buckets for the distinct contexts and bytes it holds, and sums the answers.

The base model needs the count of every word of every text. Words above a share
of all tokens, a bounded number, are broadcast; all others are sent by hash,
packed, to the tasks that hold their counts.

Cases: NULL is the empty text: no word, one end. Repeated rows count and are
scored each. Without any training text every bit has probability one half.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reckoner.llm import tally
from reckoner.llm.bytewords import LOWER, NOT_BLANK, mix, slices, text_column, words_of
from reckoner.llm.shared import ship, written

DEPTH = 5  # a key of context and byte has 64 bits, so at most 7
SPLIT = 3
LEAST = 2
END = 0xFF  # never a byte of UTF-8
PART_BYTES, ROW_BYTES = 16 << 20, 64
BLOCK = 1 << 15
LOG_HALF = math.log(0.5)
WORD_SHARE = 1e-6
U64 = np.uint64


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10 == 0


# --- contexts of positions


def tokens_only(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased words with one blank between two; bytes and offsets."""
    word = NOT_BLANK[data]
    after_word = np.r_[False, word[:-1]] if len(word) else word
    after_word[offsets[:-1][offsets[:-1] < len(data)]] = False
    keep = word | after_word
    n_before = np.r_[0, np.cumsum(keep)]
    out, ends = np.where(word, LOWER[data], 0x20)[keep], n_before[offsets]
    some = np.flatnonzero(np.diff(ends) > 0)
    last = ends[some + 1] - 1
    trailing = last[out[last] == 0x20]
    if len(trailing):
        stay = np.ones(len(out), bool)
        stay[trailing] = False
        return out[stay], np.r_[0, np.cumsum(stay)][ends]
    return out, ends


def laid_out(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts each followed by end marks; places of their bytes and one end mark; ends of texts in the places."""
    n_docs = len(offsets) - 1
    lengths = np.diff(offsets)
    doc = np.repeat(np.arange(n_docs), lengths + 1)
    places = np.arange(len(doc)) + DEPTH + doc * (DEPTH - 1)
    out = np.full(DEPTH + len(data) + n_docs * DEPTH, END, np.uint8)
    is_end = np.zeros(len(doc), bool)
    is_end[np.cumsum(lengths + 1) - 1] = True
    out[places[~is_end]] = data
    return out, places, np.r_[0, np.cumsum(lengths + 1)]


def context_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Most recent byte first, then older ones, then the byte itself; and where texts end among these keys."""
    out, places, ends = laid_out(*tokens_only(data, offsets))
    key = np.zeros(len(places), U64)
    for d in range(1, DEPTH + 1):
        key = (key << U64(8)) | out[places - d]
    return (key << U64(8)) | out[places], ends


def context_of(keys: np.ndarray, depth: int) -> np.ndarray:
    return keys >> U64(8 * (DEPTH - depth + 1))


def buckets_for(size: int) -> int:
    """Grows with the square root of the text, as do the parts that a bucket's rows come from."""
    return max(64, math.isqrt(size) // 128)


def _context_bucket(buckets: int):
    return lambda keys: (mix(context_of(keys, SPLIT)) % U64(buckets)).astype(np.int32)


def _count_contexts(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    keys = (context_keys(d, o)[0] for b in batches for _, _, d, o in slices(*text_column(b.column(0))))
    return tally.emitted(keys, _context_bucket(buckets))


# --- the tree


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, shifted by eight for accuracy."""
    product = np.ones_like(x)
    for k in range(8):
        product *= x + k
    y = x + 8
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return series - np.log(product)


def estimate(zeros, ones) -> tuple[np.ndarray, np.ndarray]:
    """Krichevsky-Trofimov: log probability of the bits, and the probability that the next is 1."""
    log_p = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - 2 * math.log(math.sqrt(math.pi))
    return log_p, (ones + 0.5) / (zeros + ones + 1)


def path_of(byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The binary nodes (numbered from 1 as in a heap) that lead to each byte, and the bits taken there."""
    level = np.arange(8, dtype=U64)
    return (U64(1) << level) | (byte[:, None] >> (U64(8) - level)), (byte[:, None] >> (U64(7) - level)) & U64(1)


def cells_of(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Binary nodes touched by counts of ``context << 8 | byte``, as sorted ``context << 8 | node``, with zeros and ones."""
    node, bit = path_of(keys & U64(0xFF))
    cells, at = np.unique(((keys[:, None] >> U64(8) << U64(8)) | node).ravel(), return_inverse=True)
    ones = np.bincount(at, (counts[:, None] * bit.astype(np.int64)).ravel(), len(cells))
    return cells, np.bincount(at, np.repeat(counts, 8), len(cells)) - ones, ones


def shorter(keys: np.ndarray) -> np.ndarray:
    """The same byte or node after a context without its oldest byte."""
    return (keys >> U64(16) << U64(8)) | (keys & U64(0xFF))


@dataclass
class Level:
    """Kept contexts of one depth, and their touched binary nodes (``cells``).

    ``given`` is the mixed probability of a 1 from the root down to here and
    ``left`` the weight of all deeper estimates; ``end`` is the probability of
    a 1 where a walk ends in the rest of this context.
    """

    contexts: np.ndarray
    cells: np.ndarray
    kt: np.ndarray
    kt_rest: np.ndarray
    stop: np.ndarray
    weighted: np.ndarray
    given: np.ndarray | None = None
    left: np.ndarray | None = None
    end: np.ndarray | None = None


def weigh(low: int, high: int, keys, counts, rest, below=None) -> dict[int, Level]:
    """The levels of depth ``low`` to ``high`` from counts of ``context << 8 | byte`` of the deepest.

    ``rest`` has the counts that no kept deeper context has, ``below`` cells of
    the deepest level with the sum of log probabilities of kept deeper ones.
    """
    levels = {}
    below = below or (np.zeros(0, U64), np.zeros(0))
    for depth in range(high, low - 1, -1):
        contexts, total = tally.summed(keys >> U64(8), counts)
        contexts = contexts[(total >= LEAST) | (depth == 0)]
        kept = found_in(contexts, keys >> U64(8))[1]
        cells, zeros, ones = cells_of(keys[kept], counts[kept])
        log_e, kt = estimate(zeros, ones)
        product, kt_rest = np.zeros(len(cells)), np.full(len(cells), 0.5)
        own = found_in(contexts, rest[0] >> U64(8))[1]
        rest_cells, zeros, ones = cells_of(rest[0][own], rest[1][own])
        at = np.searchsorted(cells, rest_cells)
        product[at], kt_rest[at] = estimate(zeros, ones)
        product[np.searchsorted(cells, below[0])] += below[1]
        mixed = np.logaddexp(log_e, product) + LOG_HALF
        levels[depth] = Level(contexts, cells, kt, kt_rest, np.exp(log_e + LOG_HALF - mixed), mixed)
        rest = tally.summed(shorter(keys[~kept]), counts[~kept])
        keys, counts = tally.summed(shorter(keys), counts)
        below = tally.summed(shorter(cells), mixed)
    return levels


def spread(levels: dict[int, Level], above: Level | None = None) -> dict[int, Level]:
    """Mix from the root, or from the level ``above``, downwards."""
    for _, level in sorted(levels.items()):
        given, left = 0.0, 1.0
        if above is not None:
            at = np.searchsorted(above.cells, shorter(level.cells))
            given, left = above.given[at], above.left[at]
        level.given = given + left * level.stop * level.kt
        level.left = left * (1 - level.stop)
        level.end = level.given + level.left * level.kt_rest
        above = level
    return levels


def log10_of(levels: dict[int, Level], keys: np.ndarray) -> np.ndarray:
    """Log10 probability of the byte of each key after its context, by the levels of all depths."""
    out = np.zeros(len(keys))
    for start in range(0, len(keys), BLOCK):
        asked = keys[start : start + BLOCK]
        node, bit = path_of(asked & U64(0xFF))
        p, known = np.full(node.shape, 0.5), np.ones(len(asked), bool)
        for depth in range(DEPTH + 1):
            level, further = levels[depth], np.zeros(len(asked), bool)
            if depth < DEPTH:
                further = known & found_in(levels[depth + 1].contexts, context_of(asked, depth + 1))[1]
            at, seen = found_in(level.cells, (context_of(asked, depth)[:, None] << U64(8)) | node)
            seen &= known[:, None]
            at = at[seen]
            # A kept deeper context that this node of it was never seen in says one half.
            p[seen] = np.where(np.broadcast_to(further[:, None], seen.shape)[seen], level.given[at] + 0.5 * level.left[at], level.end[at])
            known = further
        out[start : start + BLOCK] = np.log10(np.where(bit == 1, p, 1 - p)).sum(1)
    return out


def part_of_tree(packed: Iterator[tuple[bytes, bytes]]) -> dict[int, Level]:
    """The levels from ``SPLIT`` on of one bucket."""
    counted = tally.Tally()
    for keys, counts in packed:
        counted.add(*tally.unpack(keys, counts))
    keys, counts = counted.compact()
    return weigh(SPLIT, DEPTH, keys, counts, (keys, counts))


def _for_top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What shorter contexts need of each bucket: counts of bytes, those of the rest, log probabilities of nodes."""
    for batch in batches:
        for packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            first = part_of_tree([packed])[SPLIT]
            keys, counts = tally.unpack(*packed)
            keys, counts = tally.summed((context_of(keys, SPLIT) << U64(8)) | (keys & U64(0xFF)), counts)
            loose = ~found_in(first.contexts, keys >> U64(8))[1]
            sums = (
                tally.summed(shorter(keys), counts),
                tally.summed(shorter(keys[loose]), counts[loose]),
                tally.summed(shorter(first.cells), first.weighted),
            )
            every = np.unique(np.concatenate([k for k, _ in sums]))
            values = [np.zeros(len(every), kind) for kind in (np.int64, np.int64, float)]
            for value, (k, n) in zip(values, sums, strict=True):
                value[np.searchsorted(every, k)] = n
            yield pa.record_batch([pa.array(x) for x in (every.view(np.int64), *values)], names=["key", "n", "rest", "log_p"])


def learn(texts: DataFrame, size: int) -> tuple[DataFrame, dict[int, Level]]:
    """Counts of contexts by bucket, a written table, and the levels above ``SPLIT``, of all ``text`` of some ``size`` bytes."""
    spark = texts.sparkSession
    ship(spark)
    buckets, partitions = buckets_for(size), int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = texts.select("text").mapInArrow(lambda b: _count_contexts(b, buckets), tally.PACKED)
    counts = written(tally.merged(packed, partitions), "contexts")
    sums = counts.mapInArrow(_for_top, "key long, n long, rest long, log_p double")
    sums = sums.groupBy("key").agg(F.sum("n").alias("n"), F.sum("rest").alias("rest"), F.sum("log_p").alias("log_p")).toArrow()
    order = np.argsort(sums["key"].to_numpy())
    key, n, rest, log_p = (sums[c].to_numpy()[order] for c in ("key", "n", "rest", "log_p"))
    key = key.view(U64)
    below = (key[log_p != 0], log_p[log_p != 0])
    return counts, spread(weigh(0, SPLIT - 1, key[n > 0], n[n > 0], (key[rest > 0], rest[rest > 0]), below))


def _in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the number of the part of their task they fall in."""
    first, so_far = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        weight = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64) + ROW_BYTES
        after = so_far + np.cumsum(weight)
        part = first + (after - weight) // PART_BYTES
        so_far = int(after[-1]) if len(after) else so_far
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(part)], names=["doc_id", "text", "part"])


def _ask_contexts(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Distinct keys of each part by bucket. A part read by two tasks asks twice, which does no harm."""

    def asked(part: int, keys: np.ndarray) -> pa.RecordBatch:
        found = list(tally.split(keys, keys, _context_bucket(buckets)))
        steps = [np.diff(k, prepend=U64(0)).tobytes() for _, k, _ in found]
        columns = [pa.array([b for b, _, _ in found], pa.int32()), pa.array([part] * len(found), pa.int64()), pa.array(steps, pa.binary())]
        return pa.record_batch(columns, names=["bucket", "part", "keys"])

    now, held = None, tally.Tally()
    for batch in batches:
        parts = batch.column(0).to_numpy()
        starts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]]) if len(parts) else parts
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(parts)], strict=False):
            if now is not None and now != parts[start]:
                yield asked(now, held.compact()[0])
                held = tally.Tally()
            now = int(parts[start])
            for _, _, data, offsets in slices(*text_column(batch.column(1).slice(start, end - start))):
                held.add(context_keys(data, offsets)[0])
    if now is not None:
        yield asked(now, held.compact()[0])


def _answer_contexts(asked: pa.Table, counted: pa.Table, top) -> pa.Table:
    """Log10 probabilities of the keys that parts ask of one bucket."""
    keys = [np.cumsum(np.frombuffer(k, U64), dtype=U64) for k in asked["keys"].to_pylist()]
    every = np.unique(np.concatenate(keys)) if keys else np.zeros(0, U64)
    deep = part_of_tree(zip(counted["keys"].to_pylist(), counted["counts"].to_pylist(), strict=True))
    log10 = log10_of(top.value | spread(deep, top.value[SPLIT - 1]), every).astype(np.float32)
    values = [log10[np.searchsorted(every, k)].tobytes() for k in keys]
    return pa.table({"part": asked["part"], "keys": asked["keys"], "log10": pa.array(values, pa.binary())})


class Answers:
    """Log10 probabilities of all keys of one part."""

    def __init__(self, answers: pa.Table):
        keys = [np.cumsum(np.frombuffer(k, U64), dtype=U64) for k in answers["keys"].to_pylist()]
        log10 = [np.frombuffer(v, np.float32) for v in answers["log10"].to_pylist()]
        keys, first = np.unique(np.concatenate(keys) if keys else np.zeros(0, U64), return_index=True)
        self.places = pd.Index(keys)  # by hash: twice as fast as a binary search
        self.log10 = (np.concatenate(log10) if log10 else np.zeros(0, np.float32))[first]

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log10 probability of each text, and the bytes scored, the end mark among them."""
        keys, ends = context_keys(data, offsets)
        p = self.log10[self.places.get_indexer(keys)]
        return np.diff(np.r_[0.0, np.cumsum(p, dtype=float)][ends]), np.diff(ends)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [tally.counts_of(c) for c in batch.column(0).to_pylist()]
        yield pa.record_batch(
            [pa.array([int(c.sum()) for c in counts], pa.int64()), pa.array([len(c) for c in counts], pa.int64())], names=["n", "distinct"]
        )


# --- words of the base model


def _word_bucket(buckets: int):
    return lambda keys: ((keys >> U64(32)) % U64(buckets)).astype(np.int32)


def _token_words(column) -> Iterator[tuple[int, int, object]]:
    for first, end, data, offsets in slices(*text_column(column)):
        yield first, end, words_of(LOWER[data], offsets, NOT_BLANK)


def _count_words(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    return tally.emitted((w.hashes() for b in batches for _, _, w in _token_words(b.column(0))), _word_bucket(buckets))


def _frequent(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys, counts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            keys, counts = tally.unpack(keys, counts)
            hot = counts >= least
            yield pa.record_batch([pa.array(keys[hot].view(np.int64)), pa.array(counts[hot])], names=["word", "n"])


class Base:
    """Counts of frequent words by hash, and the constants of the unigram model."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, tokens: int, distinct: int, ends: int):
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        self.tokens, self.ends = tokens, ends
        self.log10_all = math.log10(tokens + 0.1 * (distinct + 1))

    def log10(self, counts: np.ndarray) -> np.ndarray:
        return np.log10(counts + 0.1) - self.log10_all


def found_in(words: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sorted ``words`` hold each key, and whether they do."""
    if not len(words):
        return np.zeros(keys.shape, np.int64), np.zeros(keys.shape, bool)
    at = np.searchsorted(words, keys).clip(max=len(words) - 1)
    return at, words[at] == keys


SCORED = "n_tokens long, known long, base double, score double, n_scored long, words binary, times binary"


def _score(docs: pa.Table, answers: pa.Table, base) -> pa.Table:
    """Score, the frequent part of the base score, and the other words of each document of a part."""
    n, model, unigram, text = len(docs), Answers(answers), base.value, docs["text"]
    tokens, known, part = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
    score, scored = np.zeros(n), np.zeros(n, np.int64)
    others, times = [], []
    for first, end, data, offsets in slices(*text_column(text)):
        score[first:end], scored[first:end] = model.scores(data, offsets)
    for first, end, words in _token_words(text):
        h, docs_here = words.hashes(), end - first
        tokens[first:end] = words.n_words + 1
        at, hot = found_in(unigram.words, h)
        counts = unigram.counts[at[hot]] if len(unigram.counts) else np.zeros(0, np.int64)
        known[first:end] = np.bincount(words.doc[hot], minlength=docs_here) + (unigram.ends > 0)
        part[first:end] = np.bincount(words.doc[hot], unigram.log10(counts), minlength=docs_here)
        part[first:end] += unigram.log10(np.array([unigram.ends]))
        rare_doc, rare = words.doc[~hot], h[~hot]
        order = np.lexsort((rare, rare_doc))
        rare_doc, rare = rare_doc[order], rare[order]
        new = np.flatnonzero(np.r_[True, (rare[1:] != rare[:-1]) | (rare_doc[1:] != rare_doc[:-1])]) if len(rare) else order
        often = np.diff(np.r_[new, len(rare)]).astype(np.uint32)
        limits = np.searchsorted(rare_doc[new], np.arange(docs_here + 1))
        rare = rare[new]
        for low, high in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
            others.append(rare[low:high].tobytes())
            times.append(often[low:high].tobytes())
    columns = [docs["doc_id"], *map(pa.array, (tokens, known, part, score, scored)), pa.array(others, pa.binary()), pa.array(times, pa.binary())]
    return pa.table(columns, names=["doc_id", "n_tokens", "known", "base", "score", "n_scored", "words", "times"])


ASKED = "bucket int, rows binary, words binary, times binary"


def _ask(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The words that are not frequent, packed by bucket with the numbers of their rows."""
    for batch in batches:
        words = [np.frombuffer(w, U64) for w in batch.column(1).to_pylist()]
        row = np.repeat(batch.column(0).to_numpy(), [len(w) for w in words])
        word = np.concatenate(words) if words else np.zeros(0, U64)
        often = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32)
        bucket = _word_bucket(buckets)(word)
        order = np.argsort(bucket, kind="stable")
        found, first = np.unique(bucket[order], return_index=True)
        parts = np.split(order, first[1:]) if len(found) else []
        packed = [[x[at].tobytes() for at in parts] for x in (row, word, often)]
        yield pa.record_batch([pa.array(found, pa.int32()), *[pa.array(p, pa.binary()) for p in packed]], names=["bucket", "rows", "words", "times"])


def _answer(asked: pa.Table, counted: pa.Table, base) -> pa.Table:
    """Per row, what the words of one bucket add to the base score."""
    rows, words, often = (
        np.frombuffer(b"".join(asked[c].to_pylist()), k) for c, k in (("rows", np.int64), ("words", U64), ("times", np.uint32))
    )
    keys, counts = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for packed in zip(counted["keys"].to_pylist(), counted["counts"].to_pylist(), strict=True):
        for part, to in zip(tally.unpack(*packed), (keys, counts), strict=True):
            to.append(part)
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    at, seen = found_in(keys, words)
    count = np.where(seen, counts[at], 0) if len(counts) else np.zeros(len(words), np.int64)
    row, back = np.unique(rows, return_inverse=True)
    known = np.bincount(back, often * seen, minlength=len(row)).astype(np.int64)
    part = np.bincount(back, often * base.value.log10(count), minlength=len(row)).astype(float)
    return pa.table({"row_id": row, "known": known, "base": part})


def score(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    ship(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = written(rows.mapInArrow(_in_parts, f"doc_id {kind}, text string, part long"), "parts")
    train = rows.filter(~held_out(F.col("doc_id")))
    ends, size = train.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    counts, top = learn(train, size or 0)
    top = spark.sparkContext.broadcast(top)

    buckets = max(16, (size or 0) >> 26)  # some 64 MB of text each, so answers per document stay few
    counted = train.select("text").mapInArrow(lambda b: _count_words(b, buckets), tally.PACKED)
    counted = written(tally.merged(counted, partitions), "words")
    sums = counted.select("counts").mapInArrow(_totals, "n long, distinct long").agg(F.sum("n"), F.sum("distinct")).first()
    tokens, distinct = (sums[0] or 0) + ends, (sums[1] or 0) + (ends > 0)
    hot = counted.mapInArrow(lambda b: _frequent(b, max(2, WORD_SHARE * tokens)), "word long, n long").toArrow()
    base = Base(hot["word"].to_numpy().view(U64), hot["n"].to_numpy(), tokens, distinct, ends)
    base = spark.sparkContext.broadcast(base)

    context_buckets = buckets_for(size or 0)
    contexts = rows.select("part", "text").mapInArrow(lambda b: _ask_contexts(b, context_buckets), "bucket int, part long, keys binary")
    told = contexts.groupBy("bucket").cogroup(counts.groupBy("bucket")).applyInArrow(
        lambda a, c: _answer_contexts(a, c, top), "part long, keys binary, log10 binary"
    )
    scored = rows.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(
        lambda d, a: _score(d, a, base), f"doc_id {kind}, {SCORED}"
    )
    scored = written(scored.withColumn("row_id", F.monotonically_increasing_id()), "scored")
    top.destroy()
    asked = scored.select("row_id", "words", "times").mapInArrow(lambda b: _ask(b, buckets), ASKED)
    answers = asked.groupBy("bucket").cogroup(counted.groupBy("bucket")).applyInArrow(
        lambda a, c: _answer(a, c, base), "row_id long, known long, base double"
    )
    added = answers.groupBy("row_id").agg(F.sum("known").alias("more_known"), F.sum("base").alias("more_base"))
    added = written(added, "added")
    base.destroy()
    return scored.select("row_id", "doc_id", "n_tokens", "known", "base", "score", "n_scored").join(added, "row_id", "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        "score",
        (-F.col("score") / math.log10(2) / F.col("n_scored")).alias("bits_per_byte"),
    )
