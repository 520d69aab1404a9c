"""Quality score by a byte-level convolutional network, in numpy.

Filters of five bytes, learned over one-hot bytes, run over the whole text.
Their responses are max-pooled over overlapping chunks (two blocks each), and a
document's probability comes from the mean and the maximum of its chunks. A
filter is five tables of 256 values, so a response is five lookups.

Learning takes a bounded sample: at most ``SAMPLE`` labelled rows of each label,
the smallest by a hash, of texts of every length, weighted back to the labels'
shares among all rows. A text over ``LONGEST`` characters teaches by ``PIECES``
runs of it, evenly spaced from its start to its end and ``LONGEST`` characters
in all, cut in the tasks, so the sample is at most ``2 * SAMPLE * LONGEST``
characters. Held-out rows are never learned from. The sample is learned on the
driver; scoring is done in tasks over whole texts, in blocks of fixed size,
whatever the length of a text. The weights, some 80 KB, are broadcast.

Cases: NULL and empty texts have no chunk and get the probability of zeros.
Labels that are NULL or whose document is missing are not learned from;
documents labelled twice enter once for each label. Without labels of both
kinds the score is the share of label 1, or one half.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reckoner.llm.bytewords import slices, text_column
from reckoner.llm.shared import ship, written

WIDTH, FILTERS, BLOCK = 5, 16, 256
SAMPLE, LONGEST, PIECES = 2500, 1 << 15, 16
EPOCHS, BATCH, RATE, SEED = 6, 32, 0.02, 7
POSITIONS = 1 << 16


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def laid_out(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts padded by zero bytes, the place of each byte, and for each block of a text its first byte."""
    n_docs = len(offsets) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(offsets))
    places = np.arange(len(data)) + doc * (WIDTH - 1)
    padded = np.zeros(len(data) + n_docs * (WIDTH - 1), np.uint8)
    padded[places] = data
    blocks = -(-np.diff(offsets) // BLOCK)
    inside = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    return padded, places, np.repeat(offsets[:-1], blocks) + inside * BLOCK


class Network:
    def __init__(self, prior: float, rng: np.random.Generator):
        self.tables = (rng.standard_normal((WIDTH, 256, FILTERS)) * 0.1).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.combine = (rng.standard_normal(2 * FILTERS) * 0.1).astype(np.float32)
        self.offset = np.float32(np.log(prior / (1 - prior)))

    def blocks(self, padded, places, first) -> np.ndarray:
        """Largest response of each filter in each block."""
        out = np.empty((len(first), FILTERS), np.float32)
        low = 0
        while low < len(first):
            high = max(low + 1, int(np.searchsorted(first, first[low] + POSITIONS, "right")) - 1)
            end = first[high] if high < len(first) else len(places)
            at = places[first[low] : end]
            response = self.tables[0].take(padded[at], 0)
            for j in range(1, WIDTH):
                response += self.tables[j].take(padded[at + j], 0)
            out[low:high] = np.maximum.reduceat(response, first[low:high] - first[low], 0)
            low = high
        return out

    def pooled(self, block_max: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean and maximum over the overlapping chunks of each document."""
        n, total = len(counts), len(block_max)
        start = np.cumsum(counts) - counts
        last = np.zeros(total, bool)
        some = counts > 0
        last[(start + counts - 1)[some]] = True
        following = np.where(last[:, None], block_max, np.roll(block_max, -1, 0))
        chunk = np.maximum(np.maximum(block_max, following) + self.bias, 0)
        mean, most = np.zeros((n, FILTERS), np.float32), np.zeros((n, FILTERS), np.float32)
        if total:
            mean[some] = np.add.reduceat(chunk, start[some], 0) / counts[some, None]
            most[some] = np.maximum.reduceat(chunk, start[some], 0)
        return mean, most

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        padded, places, first = laid_out(data, offsets)
        counts = -(-np.diff(offsets) // BLOCK)
        mean, most = self.pooled(self.blocks(padded, places, first), counts)
        z = np.hstack([mean, most]) @ self.combine + self.offset
        return 1 / (1 + np.exp(-z.astype(float)))

    def gradient(self, data: np.ndarray, label: float):
        """Of the log loss of one document: tables (as places and values), bias, combination, offset."""
        n = max(1, -(-len(data) // BLOCK))
        padded = np.zeros(n * BLOCK + WIDTH, np.int64)
        padded[: len(data)] = data
        response = sum(self.tables[j][padded[j : j + n * BLOCK]] for j in range(WIDTH))
        response[max(1, len(data)) :] = -np.inf
        by_block = response.reshape(n, BLOCK, FILTERS)
        place = by_block.argmax(1) + np.arange(n)[:, None] * BLOCK
        block_max = by_block.max(1)
        nxt = np.minimum(np.arange(n) + 1, n - 1)
        right = block_max[nxt] > block_max
        place = np.where(right, place[nxt], place)
        raw = np.where(right, block_max[nxt], block_max) + self.bias
        chunk = np.maximum(raw, 0)
        best = chunk.argmax(0)
        pooled = np.concatenate([chunk.mean(0), chunk.max(0)])
        error = 1 / (1 + np.exp(-(pooled @ self.combine + self.offset))) - label
        to_chunk = np.full((n, FILTERS), self.combine[:FILTERS] / n) * error
        to_chunk[best, np.arange(FILTERS)] += error * self.combine[FILTERS:]
        to_chunk *= raw > 0
        return padded, place, to_chunk, to_chunk.sum(0), error * pooled, error


def train(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, prior: float) -> Network:
    rng = np.random.default_rng(SEED)
    net = Network(prior, rng)
    params = [net.tables, net.bias, net.combine]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    offset_moment, step = [0.0, 0.0], 0
    columns = np.arange(FILTERS)
    rounds = EPOCHS * -(-len(texts) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for low in range(0, len(order), BATCH):
            grads, of_offset = [np.zeros_like(p) for p in params], 0.0
            batch = order[low : low + BATCH]
            for i in batch:
                padded, place, to_chunk, to_bias, to_combine, error = net.gradient(np.frombuffer(texts[i], np.uint8), labels[i])
                w = np.float32(weights[i] / len(batch))
                for j in range(WIDTH):
                    np.add.at(grads[0][j], (padded[place + j], columns), to_chunk * w)
                grads[1] += to_bias * w
                grads[2] += to_combine * w
                of_offset += error * w
            step += 1
            rate = RATE * (1 - step / (rounds + 1))
            for p, g, (m, v) in zip(params, grads, moments, strict=True):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-6)
            offset_moment[0] = 0.9 * offset_moment[0] + 0.1 * of_offset
            offset_moment[1] = 0.999 * offset_moment[1] + 0.001 * of_offset**2
            net.offset -= np.float32(rate * (offset_moment[0] / (1 - 0.9**step)) / (np.sqrt(offset_moment[1] / (1 - 0.999**step)) + 1e-6))
    return net


def pieces_of(text: Column, longest: int) -> Column:
    """The text, or of one over ``longest`` characters ``PIECES`` runs evenly spaced from its start to its end."""
    size, run = F.char_length(text), longest // PIECES
    starts = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda i: F.floor(i * (size - run) / (PIECES - 1)).cast("int"))
    runs = F.transform(starts, lambda start: text.substr(start + 1, F.lit(run)))
    return F.when(size <= longest, text).otherwise(F.concat_ws(" ", runs))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, longest: int):
    """A bounded sample of texts with labels, weights that restore the labels' shares, and the number of rows of each label."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(F.col("label").isin(0, 1)).distinct()
    rows = docs.filter(F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.col("text").cast("string").alias("text"))
    sized = rows.select("doc_id", F.octet_length("text").alias("size"), F.xxhash64("text").alias("key")).filter("size > 0")
    joined = written(sized.join(known, "doc_id").withColumn("order", F.xxhash64("doc_id", "label", F.lit(SEED))), "labelled")
    counts = {r[0]: r[1] for r in joined.groupBy("label").agg(F.count("*")).collect()}
    picked = []
    for value in (0, 1):
        own = joined.filter(F.col("label") == value).orderBy("order", "key").limit(most)
        picked += own.select("doc_id", "key", "label").collect()
    if not picked:
        return [], np.zeros(0), np.zeros(0), counts
    chosen = docs.sparkSession.createDataFrame(picked, joined.select("doc_id", "key", "label").schema)
    found = rows.withColumn("key", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "key"])
    cut = found.select("doc_id", "key", "label", pieces_of(F.col("text"), longest).alias("text"))
    table = cut.dropDuplicates(["doc_id", "key", "label"]).select("text", "label", "key").orderBy("key", "label").toArrow()
    y = table["label"].to_numpy().astype(float)
    share = np.array([counts.get(v, 0) for v in (0, 1)]) / max(1, sum(counts.values()))
    drawn = np.array([(y == v).mean() if len(y) else 1 for v in (0, 1)])
    weights = np.where(y == 1, share[1] / max(drawn[1], 1e-9), share[0] / max(drawn[0], 1e-9))
    return [t.encode() for t in table["text"].to_pylist()], y, weights, counts


class Constant:
    """Where there is nothing to learn."""

    def __init__(self, p: float):
        self.p = p

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.full(len(offsets) - 1, self.p)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE, longest: int = LONGEST):
    texts, y, weights, counts = labelled_sample(docs, labels, label, most, longest)
    if len(set(y.tolist())) < 2:
        return Constant(counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5)
    return train(texts, y, weights, counts[1] / sum(counts.values()))


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [model.value.scores(d, o) for _, _, d, o in slices(*text_column(batch.column(1)))]
        yield pa.record_batch([batch.column(0), pa.array(np.concatenate([np.zeros(0), *found]))], names=["doc_id", "score"])


def score(docs: DataFrame, model, threshold: float) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(lambda b: _score(b, shared), f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
