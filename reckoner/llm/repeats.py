"""Removal of long repeats between documents: seed and extend on winnowed anchors.

A window is ``LENGTH`` consecutive words. A word goes if a window over it also
stands in a document of a smaller id.

* **Seeds.** A window's anchor is the run of half its words with the least hash
  (the rightmost of equal ones), so equal windows have equal anchors at equal
  offsets, and some two of 27 words begin an anchor. The windows of an anchor's
  occurrence are neighbours; the words under them are its span.
* **Join.** Occurrences meet by anchor. Only anchors of several documents go on.
  Occurrences of equal span match in all their windows, so they are one from here
  on, with the least id that holds it: a group of copies is one span. Where all
  spans of an anchor are equal, they need no extension.
* **Extension.** Of each other anchor the spans are matched with the span of the
  least id, the pivot, word by word to the left and to the right of the anchor, as far
  as both agree. Windows inside the match are repeats. A match of fewer words than a
  window is none. Windows that the pivot does not hold may repeat another span: they
  meet by the hash of their words with those of the other spans of their anchor, and
  the least id of each is taken. So no pairs within a group are made, and none is lost.
* **Maximal repeats.** The repeated windows of a document, from all its anchors,
  united, are its maximal repeats of at least ``LENGTH`` words.

Work and what is moved are proportional to the number of anchors; contexts, at
most ``LENGTH`` words each, are read again only for anchors with unequal spans.
Runs of words are equal when their 64-bit hashes are.

Cases: NULL and empty texts have no words. Texts of fewer than ``LENGTH`` words keep
all. NULL ids come after all others, and are not smaller than each other. Rows of
one id repeat each other's passages without loss. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reckoner.llm import bitfilter
from reckoner.llm.bytewords import NOT_BLANK, Runs, Words, mix, slices, text_column, words_of
from reckoner.llm.shared import ship, written

LENGTH = 50
U64 = np.uint64


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """For every full stretch of ``width`` values, the place of its least one, the last of equal ones."""
    best, reach = np.arange(len(values)), 1

    def better(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(values[right] <= values[left], right, left)

    while 2 * reach <= width:
        best, reach = better(best[:-reach], best[reach:]), 2 * reach
    rest = width - reach
    return better(best[: len(best) - rest], best[rest:]) if rest else best


class Anchors:
    """Occurrences of anchors in a slice, in order: place, first and last window, and hashes."""

    def __init__(self, words: Words, length: int):
        size = length // 2
        self.words, self.hashes = words, words.hashes()
        runs = Runs(self.hashes)
        n = len(words) - length + 1
        start = np.flatnonzero(words.doc[:n] == words.doc[length - 1 :]) if n > 0 else np.zeros(0, np.int64)
        if len(start):
            at = np.arange(len(words) - size + 1)
            place = least_places(runs.of(at, at + size), length - size + 1)[start]
            new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        else:
            place = new = start
        self.place, self.first = place[new], start[new]
        self.last = start[np.r_[new[1:], len(start)] - 1] if len(start) else start
        self.anchor = runs.of(self.place, self.place + size)
        self.before = (self.place - self.first).astype(np.int32)  # the most words of a window before the anchor
        self.least_before = (self.place - self.last).astype(np.int32)
        span = runs.of(self.first, self.last + length)
        self.span = mix(mix(span + self.anchor) + (self.before.astype(U64) << U64(8)) + self.least_before.astype(U64))
        self.doc = words.doc[self.place]


def _sliced(batch: pa.RecordBatch, text: int) -> Iterator[tuple[int, int, Words]]:
    for first, end, data, offsets in slices(*text_column(batch.column(text))):
        yield first, end, words_of(data, offsets, NOT_BLANK)


OCCURRENCES = "text_key long, at int, before int, least_before int, anchor long, span long"


def _occurrences(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, _, words in _sliced(batch, 2):
            found = Anchors(words, length)
            row = pa.array(first + found.doc)
            at = (found.place - words.first[found.doc]).astype(np.int32)
            numbers = [at, found.before, found.least_before, found.anchor.view(np.int64), found.span.view(np.int64)]
            yield pa.record_batch(
                [batch.column(0).take(row), batch.column(1).take(row), *map(pa.array, numbers)],
                names=["doc_id", "text_key", "at", "before", "least_before", "anchor", "span"],
            )


CONTEXTS = "span long, left binary, right binary"


def _contexts(batches: Iterator[pa.RecordBatch], open_anchors, length: int) -> Iterator[pa.RecordBatch]:
    """Hashes of the words around the anchors that may be open, from the anchor outward; a span once a slice."""
    size = length // 2
    for batch in batches:
        for _, _, words in _sliced(batch, 0):
            found = Anchors(words, length)
            some = bitfilter.may_hold(open_anchors.value, found.anchor)
            spans, which = np.unique(found.span[some], return_index=True)
            at = some[which]
            left, right = [], []
            for place, first, end in zip(found.place[at].tolist(), found.first[at].tolist(), (found.last[at] + length).tolist(), strict=True):
                left.append(found.hashes[first:place][::-1].tobytes())
                right.append(found.hashes[place + size : end].tobytes())
            yield pa.record_batch([pa.array(spans.view(np.int64)), pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["span", "left", "right"])


def agreement(a: np.ndarray, b: np.ndarray) -> int:
    """The number of words from the anchor on in which two sides agree."""
    n = min(len(a), len(b))
    unlike = np.flatnonzero(a[:n] != b[:n])
    return int(unlike[0]) if len(unlike) else n


def side_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of the first 0, 1, 2, ... words of a side."""
    out = [U64(0)]
    for word in mix(words + U64(1)).tolist():
        out.append(U64((int(out[-1]) * 0x9E3779B97F4A7C15 + word + 1) & 0xFFFFFFFFFFFFFFFF))
    return np.array(out, U64)


EXTENDED = "span long, mask long, offsets array<int>, windows array<long>"


def _extend(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Bits of the windows that the pivot holds, by words before the anchor; offsets and hashes of the other windows."""
    reach = length - length // 2
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("span", "anchor", "before", "least_before", "earlier", "left", "right", "pivot_left", "pivot_right")]
        masks, offsets, windows = [], [], []
        for _, anchor, before, least_before, earlier, *sides in zip(*columns, strict=True):
            left, right, pivot_left, pivot_right = (np.frombuffer(s, U64) for s in sides)
            offset = np.arange(least_before, before + 1)
            held = (offset <= agreement(left, pivot_left)) & (reach - offset <= agreement(right, pivot_right)) & earlier
            masks.append(sum(1 << int(i) for i in offset[held]))
            other = offset[~held]
            key = mix(side_hashes(left)[other] + U64(anchor & 0xFFFFFFFFFFFFFFFF))
            windows.append(mix(key * U64(3) + side_hashes(right)[reach - other] + other.astype(U64)).view(np.int64))
            offsets.append(other)
        limits = pa.array(np.r_[0, np.cumsum([len(o) for o in offsets])].astype(np.int32))
        flat = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        yield pa.record_batch(
            [
                batch.column("span"), pa.array(masks, pa.int64()),
                pa.ListArray.from_arrays(limits, flat(offsets, pa.int64()).cast(pa.int32())), pa.ListArray.from_arrays(limits, flat(windows, pa.int64())),
            ],
            names=["span", "mask", "offsets", "windows"],
        )


def smaller(a: Column, b: Column) -> Column:
    """Whether id ``a`` is smaller than ``b``; NULL is the greatest."""
    return F.coalesce(a < b, a.isNotNull() & b.isNull())


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The repeats: doc_id, text_key, at (the word at which an anchor begins) and mask.

    Bit ``i`` of the mask tells that the window beginning ``i`` words before the
    anchor repeats one of a smaller id.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text_key", "text").mapInArrow(lambda b: _occurrences(b, length), f"doc_id {kind}, {OCCURRENCES}")
    found = written(found, "anchors")
    no_id = F.bool_or(F.isnull("doc_id"))
    seeds = found.groupBy("anchor").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), no_id.alias("no_id"), (F.min("span") != F.max("span")).alias("open")
    )
    seeds = seeds.filter((F.col("low") < F.col("high")) | (F.col("low").isNotNull() & F.col("no_id"))).select("anchor", "open")
    # Written, so that the join of a frequent anchor is one of its own and may be split; the same below.
    shared = written(found.join(written(seeds, "seeds"), "anchor"), "shared")
    spans = shared.groupBy("anchor", "span", "before", "least_before", "open").agg(F.min("doc_id").alias("first"))
    spans = written(spans, "spans")

    unlike = spans.filter("open")
    anchors = unlike.select("anchor").distinct()
    table = spark.sparkContext.broadcast(bitfilter.build(anchors, "anchor", bitfilter.log2_bits(anchors.count())))
    contexts = docs.select("text").mapInArrow(lambda b: _contexts(b, table, length), CONTEXTS)
    contexts = contexts.groupBy("span").agg(F.min("left").alias("left"), F.min("right").alias("right"))
    sided = written(unlike.join(contexts, "span"), "contexts")
    table.destroy()
    order = F.struct(F.isnull("first"), "first", "span")
    pivots = sided.groupBy("anchor").agg(F.min_by(F.struct("span", "first", "left", "right"), order).alias("pivot"))
    asked = sided.join(written(pivots, "pivots"), "anchor").filter(F.col("span") != F.col("pivot.span")).select(
        "span", "anchor", "before", "least_before", smaller(F.col("pivot.first"), F.col("first")).alias("earlier"),
        "left", "right", F.col("pivot.left").alias("pivot_left"), F.col("pivot.right").alias("pivot_right"),
    )
    extended = written(asked.mapInArrow(lambda b: _extend(b, length), EXTENDED), "extended")
    rest = extended.select("span", F.explode(F.arrays_zip("offsets", "windows")).alias("w")).join(spans.select("span", "first"), "span")
    rest = written(rest.select("span", "first", F.col("w.offsets").alias("offset"), F.col("w.windows").alias("window")), "rest")
    least = rest.groupBy("window").agg(F.min("first").alias("least"), F.count("*").alias("n")).filter("n > 1")
    other = rest.join(written(least, "windows"), "window").filter(smaller(F.col("least"), F.col("first")))
    bit = F.expr("shiftleft(1L, offset)")
    masks = extended.select("span", "mask").unionAll(other.select("span", bit.alias("mask")))
    masks = masks.groupBy("span").agg(F.bit_or("mask").alias("mask"))

    known = written(spans.join(masks, "span", "left").select("span", "first", F.coalesce("mask", F.lit(0)).alias("mask")), "masks")
    every = F.expr("shiftleft(1L, before + 1) - shiftleft(1L, least_before)")
    mask = F.when(smaller(F.col("first"), F.col("doc_id")), every).otherwise(F.col("mask"))
    return shared.join(known, "span").select("doc_id", "text_key", "at", mask.alias("mask")).filter("mask != 0")


def removed_words(words: Words, at: np.ndarray, mask: np.ndarray, length: int) -> np.ndarray:
    """Which words lie in repeated windows. ``at``: places in the slice."""
    change = np.zeros(len(words) + 1, np.int64)
    for offset in range(length - length // 2 + 1):
        start = at[(mask >> offset) & 1 == 1] - offset
        np.add.at(change, start, 1)
        np.add.at(change, start + length, -1)
    return np.cumsum(change[:-1]) > 0


def kept_bytes(words: Words, kept: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept words of each document joined by one blank: bytes and offsets."""
    place = np.flatnonzero(kept)
    more = np.zeros(len(place), bool)  # whether a kept word of the document follows
    more[:-1] = words.doc[place[1:]] == words.doc[place[:-1]]
    change = np.zeros(len(words.data) + 1, np.int32)
    np.add.at(change, words.start[place], 1)
    np.add.at(change, words.end[place] + more, -1)  # a blank follows such a word
    inside = np.cumsum(change[:-1]) > 0
    data = np.where(NOT_BLANK[words.data], words.data, 0x20).astype(np.uint8)[inside]
    size = np.bincount(words.doc[place], words.end[place] - words.start[place] + more, n_docs).astype(np.int64)
    return data, np.r_[0, np.cumsum(size)]


CLEANED = "n_words long, n_removed long, kept_sha256 string"


def _clean(batches: Iterator[pa.RecordBatch], length: int, keep_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = batch.column(2)
        limits = np.r_[0, np.cumsum(marks.value_lengths().fill_null(0).to_numpy())]
        flat = marks.flatten()
        place, mask = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(2))
        n_words, n_removed, digests, texts = [], [], [], []
        for first, end, words in _sliced(batch, 1):
            some = slice(limits[first], limits[end])
            doc = np.repeat(np.arange(end - first), np.diff(limits[first : end + 1]))
            gone = removed_words(words, words.first[doc] + place[some], mask[some], length)
            data, offsets = kept_bytes(words, ~gone, end - first)
            n_words.append(words.n_words)
            n_removed.append(np.bincount(words.doc[gone], minlength=end - first))
            said = [data[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            digests += [hashlib.sha256(t).hexdigest() for t in said]
            texts += said
        numbers = [pa.array(np.concatenate(x).astype(np.int64) if x else [], pa.int64()) for x in (n_words, n_removed)]
        columns, names = [batch.column(0), *numbers, pa.array(digests, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if keep_text:
            columns, names = [*columns, pa.array(texts, pa.binary()).cast(pa.string())], [*names, "kept"]
        yield pa.record_batch(columns, names=names)


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, and with ``keep_text`` the ``kept`` words."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    docs = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_key"))
    # Equal rows mark the same places: once each.
    marks = repeated_windows(docs, length).groupBy("doc_id", "text_key", "at").agg(F.bit_or("mask").alias("mask"))
    marks = marks.groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).agg(F.collect_list(F.struct("at", "mask")).alias("marks"))
    marked = docs.join(written(marks, "marks"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")), "left")
    kept = ", kept string" if keep_text else ""
    return marked.select("doc_id", "text", "marks").mapInArrow(lambda b: _clean(b, length, keep_text), f"doc_id {kind}, {CLEANED}{kept}")
