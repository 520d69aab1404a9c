"""Near-duplicates by improved consistent weighted sampling, banded and verified.

* **Weights.** A document is its five-word shingles, weighted by occurrences
  times inverse document frequency, ``log(1 + documents / holding ones)`` of every
  shingle, counted over all documents of different shingles: a text and its exact
  copies count once, or their number would weigh down what near copies share. Texts
  are packed to chunks; each chunk asks every bucket of shingles, by upper bits, for
  the frequencies of those it holds, a shingle once, and is signed when the answers
  have come. So what is common weighs less, as boilerplate does. Frequencies count as
  the root of their square and that of ``RARE`` of all documents, so no weight grows with the
  corpus: else a word edited in one copy, at ``log(1 + documents)``, would count for
  ever more of what a group of copies shares, the larger corpus and group are.
* **Samples.** Ioffe's sampling draws shingle and quantised weight such that two
  documents draw the same with their weighted Jaccard similarity as
  probability. ``BANDS`` bands of ``ROWS`` samples are the buckets: a pair of
  similarity 0.8 misses all with probability 0.2 %.
* **Links.** Documents of equal shingles are one from here on. A bucket is not
  expanded into pairs: its members are compared with a pivot, the member that
  met most others. Two members similar to the pivot are of one class by it. A match
  of a member that is not similar to it must deviate from the pivot in the same
  way somewhere, by a shingle that both hold beyond it or both lack: were all their
  deviations different, their distance would be the sum of both deviations, which is
  more than a match allows. How much must be shared follows from the deviations'
  weights, so members whose deviations nobody shares are done, and the others are
  joined by prefix filter: deviations from a pivot ordered by the number of members
  that show them, each member by the rarest that no match can do without. What
  meets there, unless of one class already, is compared. So the classes are those of
  all similar pairs that share a bucket, in one step, whatever its size. Verified
  pairs of weighted Jaccard similarity 0.8 or more are links; their connected
  components are the classes.

Only documents that share a bucket are read again. Hot buckets are plain joins,
which adaptive execution splits.

Cases: texts without words, NULL and empty ones, are classes of their own. A
text of fewer than five words is one shingle. Repeated rows are one class. The
smallest ``doc_id`` of a class stays (NULL last; of equal ids one row).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reckoner.llm import bitfilter, tally
from reckoner.llm.bytewords import ALPHANUMERIC, LOWER, Words, mix, shingles_of, slices, text_column, words_of
from reckoner.llm.components import components
from reckoner.llm.shared import ship, written

SHINGLE = 5
THRESHOLD = 0.8
ROWS, BANDS = 3, 9
# Shingles of a smaller share of all documents would weigh the same; at 0 each weighs by its own frequency.
FLOOR = 0.0
# Frequencies far below this share of all documents weigh almost the same, at any number of documents.
RARE = 0.002
SEED = 0x5DEECE66D
U64 = np.uint64
LOW48 = U64((1 << 48) - 1)
BLOCK = 1 << 16
HOPS = 3
CHUNK_BYTES = BUCKET_BYTES = 4 << 20


def sets_of(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document in the slice, 48-bit shingle and occurrences, sorted."""
    values, docs = shingles_of(words, SHINGLE)
    key = np.sort((docs.astype(U64) << U64(48)) | (values >> U64(16)))
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return (key[new] >> U64(48)).astype(np.int64), key[new] & LOW48, np.diff(np.r_[new, len(key)])


def _sliced(column) -> Iterator[tuple[int, int, Words]]:
    for first, end, data, offsets in slices(*text_column(column)):
        yield first, end, words_of(LOWER[data], offsets, ALPHANUMERIC)


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows packed to chunks of some ``size`` bytes, each one value; a row counts 64 bytes beside its text."""
    number, held, missing = TaskContext.get().partitionId() << 32, [], size

    def chunk() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for part in held:
                out.write_batch(part)
        return pa.record_batch([pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "packed"])

    for batch in batches:
        at, first = text_column(batch.column(1))[1] + 64 * np.arange(len(batch) + 1), 0
        while first < len(batch):
            end = max(int(np.searchsorted(at, at[first] + missing, "right")) - 1, first + 1)
            held.append(batch.slice(first, end - first))
            missing -= int(at[end] - at[first])
            if missing <= 0 or end < len(batch):
                yield chunk()
                number, held, missing = number + 1, [], size
            first = end
    if held:
        yield chunk()


def _unpacked(packed: bytes) -> tuple[pa.Table, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The rows of a chunk and, a slice each, their documents, shingles and occurrences."""
    rows = pa.ipc.open_stream(packed).read_all()
    sets = []
    for first, _, words in _sliced(rows.column(1)):
        doc, shingles, times = sets_of(words)
        sets.append((first + doc, shingles, times))
    return rows, sets


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A fingerprint of the shingles of each text that has any."""
    for batch in batches:
        for packed in batch.column(0):
            for sets in _unpacked(packed.as_buffer())[1]:
                yield pa.record_batch([pa.array(fingerprints(*sets)[:, 0].copy().view(np.int64))], names=["print"])


def repeated_prints(chunks: DataFrame) -> DataFrame:
    """Fingerprints of shingles that several rows have, and of how many (``print``, ``n``)."""
    prints = chunks.select("packed").mapInArrow(_prints, "print long")
    return written(prints.groupBy("print").agg(F.count("*").alias("n")).filter("n > 1"), "repeated")


ASKED = "bucket int, chunk long, high binary, low binary, n binary, place binary, print binary"


def _distinct(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different pairs, by key."""
    order = np.lexsort((prints, keys))
    keys, prints = keys[order], prints[order]
    new = np.r_[True, (keys[1:] != keys[:-1]) | (prints[1:] != prints[:-1])][: len(keys)]
    return keys[new], prints[new]


def _ask(batches: Iterator[pa.RecordBatch], log2_buckets: int, repeated) -> Iterator[pa.RecordBatch]:
    """Shingles of each chunk, in order, by their upper bits, with the number of its documents that hold them.

    Documents that may be ``repeated`` are not counted in it: for each shingle that
    they hold go its place and their fingerprints, each once.
    """
    for batch in batches:
        for number, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counts, of_copies, by = tally.Tally(), [np.zeros(0, U64)], [np.zeros(0, U64)]
            for doc, shingles, times in _unpacked(packed.as_buffer())[1]:
                if repeated is None:
                    counts.add(shingles)
                    continue
                prints = fingerprints(doc, shingles, times)[:, 0]
                which = np.cumsum(np.r_[False, doc[1:] != doc[:-1]])[: len(doc)]
                again = np.zeros(len(prints), bool)
                again[bitfilter.may_hold(repeated.value, prints)] = True
                again = again[which]
                counts.add(*tally.summed(shingles, (~again).astype(np.int64)))
                of_copies.append(shingles[again])
                by.append(prints[which[again]])
            keys, n = counts.compact()
            copied, by = _distinct(np.concatenate(of_copies), np.concatenate(by))
            bucket = (keys >> U64(48 - log2_buckets)).astype(np.int32)
            at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(keys) else np.zeros(0, np.int64)
            place = np.searchsorted(keys, copied)
            cuts = np.searchsorted(place, at[1:])
            place = (place - at[np.searchsorted(at, place, "right") - 1]).astype(np.uint32) if len(place) else place.astype(np.uint32)
            parts = [np.split(x, at[1:]) if len(at) else [] for x in ((keys >> U64(32)).astype(np.uint16), keys.astype(np.uint32), n.astype(np.uint32))]
            parts += [np.split(x, cuts) if len(at) else [] for x in (place, by)]
            columns = [pa.array([x.tobytes() for x in xs], pa.binary()) for xs in parts]
            names = ["bucket", "chunk", "high", "low", "n", "place", "print"]
            yield pa.record_batch([pa.array(bucket[at]), pa.array(np.full(len(at), number)), *columns], names=names)


def _answer(asked: pa.Table) -> pa.Table:
    """For each chunk's shingles of a bucket, the number of all documents that hold them, of equal fingerprints one."""
    kinds = (("high", np.uint16), ("low", np.uint32), ("n", np.uint32), ("place", np.uint32), ("print", U64))
    high, low, n, place, prints = (np.frombuffer(b"".join(asked[c].to_pylist()), k) for c, k in kinds)
    _, back = np.unique(high.astype(U64) << U64(32) | low, return_inverse=True)
    size, copies = (np.array([len(x) >> 2 for x in asked[c].to_pylist()]) for c in ("low", "place"))
    copied, _ = _distinct(back[place + np.repeat(np.cumsum(size) - size, copies)], prints)
    held = np.bincount(back, n)
    held = (held + np.bincount(copied, minlength=len(held))).astype(np.uint32)[back]
    answers = [x.tobytes() for x in np.split(held, np.cumsum(size)[:-1])]
    return pa.table({"chunk": asked["chunk"], "bucket": asked["bucket"], "documents": pa.array(answers, pa.binary())})


def inverse_frequency(documents: np.ndarray, total: int) -> np.ndarray:
    return np.log1p(total / np.hypot(np.maximum(documents, FLOOR * total), RARE * total)).astype(np.float32)


def samples(doc: np.ndarray, shingles: np.ndarray, weights: np.ndarray, count: int) -> np.ndarray:
    """``count`` samples per document: one row per document that has shingles."""
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
    size = np.diff(np.r_[first, len(doc)])
    out = np.empty((len(first), count), U64)
    log_w = np.log(weights)
    cost, step = np.empty(len(doc), np.float32), np.empty(len(doc), np.float32)
    unit = np.float32(1 / (1 << 21))
    for k in range(count):
        salt = U64((2 * k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        for low in range(0, len(doc), BLOCK):  # blocks that stay in the processor's cache
            at = slice(low, low + BLOCK)
            h = mix(shingles[at] * salt + U64(SEED + k))
            g = mix(h + salt)
            u = ((h & U64(0x1FFFFF)).astype(np.float32) + np.float32(0.5)) * unit
            u *= (((h >> U64(21)) & U64(0x1FFFFF)).astype(np.float32) + np.float32(0.5)) * unit
            r = -np.log(u)
            beta = (h >> U64(42)).astype(np.float32) * np.float32(1 / (1 << 22))
            u = ((g & U64(0xFFFFFFFF)).astype(np.float64) + 0.5) * (1 / (1 << 32))
            u *= ((g >> U64(32)).astype(np.float64) + 0.5) * (1 / (1 << 32))
            log_c = np.log(-np.log(u).astype(np.float32))
            t = np.floor(log_w[at] / r + beta)
            step[at] = t
            cost[at] = log_c - r * (t - beta) - r
        least = np.minimum.reduceat(cost, first) if len(first) else cost[:0]
        at = np.flatnonzero(cost == np.repeat(least, size))
        at = at[np.searchsorted(at, first)]  # the first of equal ones
        out[:, k] = mix(shingles[at] * salt + (step[at].astype(np.int64) + (1 << 20)).astype(U64))
    return out


def fingerprints(doc: np.ndarray, shingles: np.ndarray, times: np.ndarray) -> np.ndarray:
    """128 bits of each document's shingles and occurrences."""
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
    h = mix(shingles * U64(0xD6E8FEB86659FD93) + times.astype(U64))
    parts = [np.add.reduceat(x, first) if len(first) else x for x in (h, mix(h + U64(SEED)))]
    return np.stack(parts, 1)


SIGNED = "print_a long, print_b long, bands array<long>, documents binary"


def _sign(chunk: pa.Table, answers: pa.Table, total: int) -> pa.Table:
    """Fingerprint, buckets and document frequencies of a chunk's rows."""
    rows, sets = _unpacked(chunk["packed"][0].as_buffer())
    n = len(rows)
    prints, bands, has = np.zeros((n, 2), U64), np.zeros((n, BANDS), U64), np.zeros(n, bool)
    frequencies = np.full(n, b"", object)
    order = np.argsort(answers["bucket"].to_numpy())
    held = np.frombuffer(b"".join(answers["documents"].take(pa.array(order)).to_pylist()), np.uint32)
    keys = np.unique(np.concatenate([x for _, x, _ in sets]))
    for doc, shingles, times in sets:
        documents = held[np.searchsorted(keys, shingles)]
        at = np.unique(doc)
        has[at] = True
        prints[at] = fingerprints(doc, shingles, times)
        frequencies[at] = [x.tobytes() for x in np.split(documents, np.flatnonzero(np.diff(doc)) + 1)][: len(at)]
        drawn = samples(doc, shingles, inverse_frequency(documents, total) * times.astype(np.float32), ROWS * BANDS)
        for band in range(BANDS):
            key = np.full(len(at), band, U64)
            for row in range(ROWS):
                key = mix(key + drawn[:, band * ROWS + row])
            bands[at, band] = key
    lists = pa.ListArray.from_arrays(
        pa.array(np.r_[0, np.cumsum(has * BANDS)].astype(np.int32)), pa.array(bands[has].ravel().view(np.int64))
    )
    columns = [rows.column(0), rows.column(2), pa.array(prints[:, 0].copy().view(np.int64)), pa.array(prints[:, 1].copy().view(np.int64))]
    return pa.table([*columns, lists, pa.array(frequencies, pa.binary())], names=["doc_id", "text_key", "print_a", "print_b", "bands", "documents"])


def _grown(size: int) -> float:
    return min(max(1.0, math.sqrt(size / 1e9)), 8)


def chunked(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` (doc_id, text, text_key) packed to chunks: ``chunk``, ``packed``. ``size``: bytes of all texts."""
    chunk_bytes = int(CHUNK_BYTES * _grown(size))
    return written(rows.mapInArrow(lambda b: _chunks(b, chunk_bytes), "chunk long, packed binary"), "chunks")


def signatures(rows: DataFrame, total: int, size: int, chunks: DataFrame | None = None, repeated: DataFrame | None = None) -> DataFrame:
    """Per row of ``rows`` (doc_id, text, text_key): doc_id, text_key and ``SIGNED``. ``size``: bytes of all texts.

    Chunks of texts ask buckets of shingles in how many documents each shingle
    is. Beyond a gigabyte of text both grow by its square root, to 32 MB. Rows of
    a fingerprint in ``repeated`` are one document in these numbers; a Bloom filter
    of it only tells whose fingerprints are to be compared. ``chunks``: those of ``rows``,
    if there already.
    """
    chunks = chunked(rows, size) if chunks is None else chunks
    table = None
    if repeated is not None:
        found = bitfilter.build(repeated, "print", bitfilter.log2_bits(repeated.count()))
        table = rows.sparkSession.sparkContext.broadcast(found)
    kind = rows.schema["doc_id"].dataType.simpleString()
    log2_buckets = math.ceil(math.log2(max(1, size / (BUCKET_BYTES * _grown(size)))))
    asked = chunks.mapInArrow(lambda b: _ask(b, log2_buckets, table), ASKED)
    answers = asked.groupBy("bucket").applyInArrow(_answer, "chunk long, bucket int, documents binary")
    both = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return both.applyInArrow(lambda chunk, found: _sign(chunk, found, total), f"doc_id {kind}, text_key long, {SIGNED}")


VECTORS = "print_a long, print_b long, shingles binary, times binary"


def _vectors(batches: Iterator[pa.RecordBatch], wanted) -> Iterator[pa.RecordBatch]:
    """Shingles (32 bits, which suffice for one pair) and occurrences of the documents that share a bucket."""
    for batch in batches:
        keep = bitfilter.may_hold(wanted.value, batch.column(1).to_numpy().view(U64))
        a, b, shingle_bytes, times_bytes = [], [], [], []
        for _, _, words in _sliced(batch.column(0).take(pa.array(keep))):
            doc, shingles, times = sets_of(words)
            prints = fingerprints(doc, shingles, times).view(np.int64)
            limits = np.r_[np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]), len(doc)].tolist() if len(doc) else [0]
            for i, (low, high) in enumerate(zip(limits[:-1], limits[1:], strict=True)):
                a.append(int(prints[i, 0]))
                b.append(int(prints[i, 1]))
                short = (shingles[low:high] >> U64(16)).astype(np.uint32)  # still sorted
                shingle_bytes.append(short.tobytes())
                times_bytes.append(times[low:high].astype(np.float32).tobytes())
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        yield pa.record_batch(
            [pa.array(x, k) for x, k in zip((a, b, shingle_bytes, times_bytes), kinds, strict=True)],
            names=["print_a", "print_b", "shingles", "times"],
        )


def _weigh(batches: Iterator[pa.RecordBatch], total: int) -> Iterator[pa.RecordBatch]:
    """Occurrences times inverse document frequencies."""
    for batch in batches:
        times, documents = (batch.column(i).to_pylist() for i in (2, 3))
        weights = [np.frombuffer(t, np.float32) * inverse_frequency(np.frombuffer(d, np.uint32), total) for t, d in zip(times, documents, strict=True)]
        packed, mass = pa.array([w.tobytes() for w in weights], pa.binary()), pa.array([float(w.sum(dtype=float)) for w in weights], pa.float64())
        yield pa.record_batch([batch.column(0), batch.column(1), packed, mass], names=["node", "shingles", "weights", "mass"])


def weighted_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Sum of minima over sum of maxima; ``a`` and ``b`` are sorted."""
    if not len(a) or not len(b):
        return 0.0
    at = np.searchsorted(b, a).clip(max=len(b) - 1)
    shared = b[at] == a
    both = float(np.minimum(wa[shared], wb[at[shared]]).sum(dtype=float))
    return both / (float(wa.sum(dtype=float)) + float(wb.sum(dtype=float)) - both)


def deviations(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ``a`` holds beyond ``b`` (even numbers) and lacks of it (odd ones), and by how much."""
    at = np.searchsorted(b, a).clip(max=max(0, len(b) - 1))
    both = b[at] == a if len(b) else np.zeros(len(a), bool)
    more = wa - np.where(both, wb[at], 0) if len(b) else wa
    other = np.ones(len(b), bool)
    other[at[both]] = False
    shingle = np.r_[a[more > 0], a[more < 0], b[other]].astype(np.int64)
    lacking = np.r_[np.zeros((more > 0).sum(), np.int64), np.ones((more < 0).sum() + other.sum(), np.int64)]
    return shingle << 1 | lacking, np.r_[more[more > 0], -more[more < 0], wb[other]].astype(np.float32)


COMPARED = "node long, pivot long, similarity double, mass double, pivot_mass double, deviation double, features binary, by binary"
SLICE_ROWS = 256


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of rows with the four arrays of each from column 2 on."""
    kinds = (np.uint32, np.float32) * 2
    for low in range(0, len(batch), SLICE_ROWS):
        some = batch.slice(low, SLICE_ROWS)
        rows = zip(*(some.column(i).to_pylist() for i in range(2, 6)), strict=True)
        yield some, [[np.frombuffer(x, k) for x, k in zip(row, kinds, strict=True)] for row in rows]


def _compare(batches: Iterator[pa.RecordBatch], in_full: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some, rows in _sets(batch):
            columns = [some.column(0), some.column(1), pa.array([weighted_jaccard(*r) for r in rows], pa.float64())]
            names = ["node", "pivot", "similarity"]
            if in_full:
                found = [deviations(*r) for r in rows]
                total = lambda arrays: pa.array([float(x.sum(dtype=float)) for x in arrays], pa.float64())
                columns += [total(r[1] for r in rows), total(r[3] for r in rows), total(w for _, w in found)]
                columns += [pa.array([x.tobytes() for x in xs], pa.binary()) for xs in zip(*found, strict=True)] if found else [pa.array([], pa.binary())] * 2
                names += ["mass", "pivot_mass", "deviation", "features", "by"]
            yield pa.record_batch(columns, names=names)


def compared(pairs: DataFrame, vectors: DataFrame, in_full: bool) -> DataFrame:
    """Similarity of each node to its pivot and, in full, its deviations from it."""
    own = vectors.select("node", F.col("shingles").alias("s"), F.col("weights").alias("w"))
    other = vectors.select(F.col("node").alias("pivot"), F.col("shingles").alias("ps"), F.col("weights").alias("pw"))
    rows = pairs.join(own, "node").join(other, "pivot").select("node", "pivot", "s", "w", "ps", "pw")
    return rows.mapInArrow(lambda b: _compare(b, in_full), COMPARED if in_full else "node long, pivot long, similarity double")


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each deviation of a node from a pivot."""
    for batch in batches:
        for low in range(0, len(batch), SLICE_ROWS):
            some = batch.slice(low, SLICE_ROWS)
            features, by = (b"".join(some.column(i).to_pylist()) for i in (2, 3))
            size = [len(x) >> 3 for x in some.column(2).to_pylist()]
            node, pivot = (np.repeat(some.column(i).to_numpy(), size) for i in range(2))
            columns = [node, pivot, np.frombuffer(features, np.int64), np.frombuffer(by, np.float32)]
            yield pa.record_batch([pa.array(c) for c in columns], names=["node", "pivot", "feature", "by"])


def candidates(now: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """Pairs of nodes not of one label that may be similar though one of them is not similar to the pivot of both.

    With ``c = (1 - t) / (1 + t)``, x and y are similar when the weight in which they
    differ is at most c times the weight of both. That weight is the sum of
    their deviations less twice what these share. So they must share half of
    ``gap(x) + need(y)``, where gap is the deviation of x less c times the weight of
    x and the pivot, above 0 for the unlike, and need the deviation of y less c
    times what y weighs more than the pivot, which is never below 0.
    """
    c = (1 - threshold) / (1 + threshold)
    slack = F.col("mass") * 1e-4  # weights are single precision
    rows = now.select(
        "node", "pivot", "features", "by", "deviation", slack.alias("slack"),
        (F.col("similarity") < threshold).alias("unlike"),
        (F.col("deviation") - c * (F.col("mass") + F.col("pivot_mass"))).alias("gap"),
        (F.col("deviation") - c * (F.col("mass") - F.col("pivot_mass"))).alias("need"),
    ).join(labels, "node")
    rows = written(rows, "deviating")
    groups = rows.groupBy("pivot").agg(
        F.min(F.when(F.col("unlike"), F.col("gap"))).alias("least_gap"), F.min("need").alias("least_need"),
        F.min("label").alias("low"), F.max("label").alias("high"),
    ).filter("least_gap IS NOT NULL AND low != high").select("pivot", "least_gap", "least_need")
    open_rows = rows.join(written(groups, "groups"), "pivot")

    features = open_rows.select("node", "pivot", "features", "by").mapInArrow(_feature_rows, "node long, pivot long, feature long, by float")
    features = written(features, "features")
    counts = features.groupBy("pivot", "feature").agg(F.count("*").alias("n")).filter("n > 1")
    common = features.join(written(counts, "counts"), ["pivot", "feature"])
    rarest = Window.partitionBy("pivot", "node").orderBy("n", "feature")
    common = common.select(
        "pivot", "node", "feature", F.sum("by").over(rarest).alias("upto"), "by",
        F.sum("by").over(Window.partitionBy("pivot", "node")).alias("shareable"),
    )
    sized = open_rows.select(
        "pivot", "node", "label", "slack", "gap", "need", (F.col("need") + F.col("least_gap")).alias("as_other"),
        F.when(F.col("unlike"), F.col("gap") + F.col("least_need")).alias("as_unlike"),
    )
    common = common.join(sized, ["pivot", "node"]).withColumn("spare", F.col("shareable") - F.col("upto") + F.col("by") + F.col("slack"))
    common = common.filter((2 * F.col("spare") >= F.col("as_other")) | (2 * F.col("spare") >= F.col("as_unlike")))
    common = written(common.select("pivot", "feature", "node", "label", "gap", "need", "spare", "as_other", "as_unlike"), "prefixes")
    probes = common.filter(2 * F.col("spare") >= F.col("as_unlike")).select("pivot", "feature", "node", "label", "gap", "spare")
    others = common.filter(2 * F.col("spare") >= F.col("as_other")).select(
        "pivot", "feature", F.col("node").alias("other"), F.col("label").alias("other_label"), "need", F.col("spare").alias("other_spare")
    )
    # All that a pair shares follows the first that it shares, so there either's spare is as much as the pair needs.
    enough = 2 * F.least("spare", "other_spare") >= F.col("gap") + F.col("need")
    pairs = probes.join(others, ["pivot", "feature"]).filter("node != other AND label != other_label").filter(enough)
    return pairs.select(F.least("node", "other").alias("node"), F.greatest("node", "other").alias("pivot")).distinct()


def _relabelled(labels: DataFrame, links_: DataFrame) -> DataFrame:
    """The least label of the neighbours, a few times: nodes of one label are of one class, not always the reverse."""
    both = links_.unionAll(links_.select(F.col("v").alias("u"), F.col("u").alias("v")))
    for _ in range(HOPS):
        near = both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("label").alias("least"))
        joined = labels.join(near, labels.node == near.u, "left")
        labels = written(joined.select("node", F.least("label", "least").alias("label")), "labels")
    return labels


def links(members: DataFrame, vectors: DataFrame, scores: DataFrame, threshold: float) -> DataFrame:
    """Verified links ``u``, ``v``, enough for the classes of all similar pairs that share a bucket. ``members``: bucket, node."""
    links_of = lambda rows: rows.filter(F.col("similarity") >= threshold).select(F.col("node").alias("u"), F.col("pivot").alias("v"))
    # Of members that met as many, the lightest: edits, which are rare, and additions weigh more, and all others would share that they lack those of the pivot.
    ranked = members.join(scores.join(vectors.select("node", "mass"), "node"), "node")
    heads = ranked.groupBy("bucket").agg(F.max_by("node", F.struct("score", -F.col("mass"), -F.col("node"))).alias("pivot"))
    asked = members.join(written(heads, "pivots"), "bucket").filter("node != pivot").select("node", "pivot").distinct()
    now = written(compared(asked, vectors, in_full=True), "compared")
    labels = _relabelled(vectors.select("node", F.col("node").alias("label")), links_of(now))
    tested = now.select(F.least("node", "pivot").alias("node"), F.greatest("node", "pivot").alias("pivot"))
    pairs = written(candidates(now, labels, threshold), "candidates").join(tested, ["node", "pivot"], "left_anti")
    last = written(compared(pairs, vectors, in_full=False), "links")
    return links_of(now).unionAll(links_of(last))


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: row_id, doc_id, text_key, class_id, class_size, kept.

    ``text_key`` is a hash of the text, to find the row again.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.col("text").cast("string")
    total, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64("text").alias("text_key"))
    chunks = chunked(rows, size)
    repeated = repeated_prints(chunks)
    total -= repeated.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).first()[0]
    signed = signatures(rows, total, size, chunks, repeated)
    signed = written(signed.withColumn("row_id", F.monotonically_increasing_id()), "signatures")

    keeper = F.min(F.struct(F.isnull("doc_id").alias("unknown"), "doc_id", "row_id")).alias("keeper")
    some = signed.filter(F.size("bands") > 0)
    bands = [F.min(F.get("bands", F.lit(i))).alias(f"band_{i}") for i in range(BANDS)]
    nodes = some.groupBy("print_a", "print_b").agg(
        F.min("row_id").alias("node"), F.min("text_key").alias("text_key"), keeper, F.count("*").alias("size"), *bands
    )
    nodes = written(nodes, "nodes")
    listed = nodes.select("node", F.explode(F.array(*[f"band_{i}" for i in range(BANDS)])).alias("bucket"))
    shared = written(listed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    members = written(listed.join(shared, "bucket"), "members")
    scores = written(members.groupBy("node").agg(F.sum("n").alias("score")), "scores")
    members = members.select("bucket", "node")

    wanted = written(nodes.join(scores.select("node"), "node").select("print_a", "print_b", "node", "text_key"), "wanted")
    bits = bitfilter.log2_bits(wanted.count())
    table = spark.sparkContext.broadcast(bitfilter.build(wanted, "text_key", bits))
    again = rows.select("text", "text_key").mapInArrow(lambda b: _vectors(b, table), VECTORS)
    again = again.groupBy("print_a", "print_b").agg(F.min("shingles").alias("shingles"), F.min("times").alias("times"))
    frequencies = signed.select(F.col("row_id").alias("node"), "documents")
    vectors = wanted.join(again, ["print_a", "print_b"]).join(frequencies, "node").select("node", "shingles", "times", "documents")
    vectors = vectors.mapInArrow(lambda b: _weigh(b, total), "node long, shingles binary, weights binary, mass double")
    vectors = written(vectors, "vectors")

    roots = components(links(members, vectors, scores, threshold))
    placed = nodes.join(roots.withColumnRenamed("u", "node"), "node", "left").select(
        "print_a", "print_b", F.coalesce("v", "node").alias("root"), "keeper", "size"
    )
    placed = written(placed, "roots")
    classes = placed.groupBy("root").agg(F.min("keeper").alias("keeper"), F.sum("size").alias("class_size"))
    of_print = written(placed.select("print_a", "print_b", "root").join(written(classes, "classes"), "root"), "of_print")
    return signed.join(of_print, ["print_a", "print_b"], "left").select(
        "row_id", "doc_id", "text_key",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("keeper.doc_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        (F.col("root").isNull() | (F.col("keeper.row_id") == F.col("row_id"))).alias("kept"),
    )
