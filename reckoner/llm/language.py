"""Language ID with language-bitmask n-gram filters.

An n-gram is four bytes of the lower-cased text in which all but letters are
blanks, with letters in the middle. A bit-sliced Bloom filter holds, in each
slot, one bit per language; the bitwise AND of an n-gram's slots names all
languages that contain it. A language's popcount over a document, less what
false positives add, says how many of the document's n-grams it knows; most
decides, and the share is the score.

Learning counts n-grams per language in tasks and sums them; an n-gram belongs
to a language if it makes up ``SHARE`` of its n-grams. So the filter has at
most ``1 / SHARE`` n-grams a language at any size, and stray text of another
language does not fill it. The slots, of fixed number, are what reaches the
driver and is broadcast: 64 languages take 8 MB.

Cases: NULL texts and texts without a letter are ``und`` with score 0. Texts
with letters but without n-gram get the first learned language and score 0.
Ties go to the first language in code point order. Rows with NULL language,
NULL text or held out are not learned from; without any, all is ``und``.
Repeated rows are each judged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reckoner.llm import tally
from reckoner.llm.bytewords import mix, slices, text_column
from reckoner.llm.shared import ship

N = 4
PROBES = 3
LOG2_SLOTS = 20
SHARE = 2e-5
# Texts of some bytes are worked on at once: an n-gram takes some sixty times its byte meanwhile.
AT_ONCE = 1 << 18

LETTER = np.array([0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
CLEAN = np.array([b if LETTER[b] else 0x20 for b in range(256)], dtype=np.uint8)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def grams_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of lower-cased texts and their documents. Texts are padded by a blank on each side."""
    n_docs = len(offsets) - 1
    padded = np.full(len(data) + 2 * n_docs, 0x20, np.uint8)
    doc_of = np.repeat(np.arange(n_docs, dtype=np.int32), np.diff(offsets) + 2)
    at = np.arange(len(data)) + 2 * np.repeat(np.arange(n_docs), np.diff(offsets)) + 1
    padded[at] = CLEAN[data]
    m = max(0, len(padded) - N + 1)
    wide = padded.astype(np.uint32)
    gram = np.zeros(m, np.uint32)
    for j in range(N):
        gram = (gram << np.uint32(8)) | wide[j : j + m]
    letter = padded != 0x20
    good = (doc_of[:m] == doc_of[N - 1 :]) if m else np.zeros(0, bool)
    for j in range(1, N - 1):
        good &= letter[j : j + m]
    return gram[good], doc_of[:m][good]


def _lower(column):
    return pc.utf8_lower(column)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = pc.dictionary_encode(batch.column(0))
        names, codes = langs.dictionary, langs.indices.to_numpy()
        counts = tally.Tally()
        for first, end, data, offsets in slices(*text_column(_lower(batch.column(1))), AT_ONCE):
            gram, doc = grams_of(data, offsets)
            counts.add((codes[first:end][doc].astype(np.uint64) << np.uint64(32)) | gram)
        key, n = counts.compact()
        if not len(key):
            continue
        lang = names.take(pa.array((key >> np.uint64(32)).astype(np.int64)))
        gram = pa.array((key & np.uint64(0xFFFFFFFF)).astype(np.int64))
        yield pa.record_batch([lang, gram, pa.array(n)], names=["lang", "gram", "n"])


def slots_of(gram: np.ndarray) -> list[np.ndarray]:
    h = mix(gram.astype(np.uint64))
    return [((h >> np.uint64(21 * i)) & np.uint64((1 << LOG2_SLOTS) - 1)).astype(np.int64) for i in range(PROBES)]


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slots = np.concatenate(slots_of(batch.column(0).to_numpy()))
        again = [pa.array(np.tile(batch.column(i).to_numpy(), PROBES)) for i in (1, 2)]
        yield pa.record_batch([pa.array(slots), *again], names=["slot", "word", "mask"])


class Filters:
    """The languages, and for each slot their bits in words of 64."""

    def __init__(self, languages: list[str], slices_: np.ndarray):
        self.languages, self.slices = languages, slices_
        fill = [float(((slices_[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()) for i in range(len(languages))]
        self.false_positive = np.array(fill) ** PROBES

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per document: number of n-grams, and corrected popcount of every language."""
        gram, doc = grams_of(data, offsets)
        n_docs = len(offsets) - 1
        n = np.bincount(doc, minlength=n_docs)
        slots = slots_of(gram)
        held = np.empty((n_docs, len(self.languages)))
        for word in range(self.slices.shape[1]):
            column = self.slices[:, word]
            masks = column[slots[0]]
            for more in slots[1:]:
                masks &= column[more]
            for i in range(64 * word, min(64 * (word + 1), len(self.languages))):
                held[:, i] = np.bincount(doc[(masks >> np.uint64(i % 64)) & np.uint64(1) == 1], minlength=n_docs)
        corrected = (held - n[:, None] * self.false_positive) / (1 - self.false_positive)
        return n, corrected.clip(0)


def learn(docs: DataFrame) -> Filters:
    """Filters from the rows of ``docs`` that have a text and a language and are not held out."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(_learn, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = counts.persist()
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    languages = sorted((r[0] for r in totals.collect()), key=str.encode)
    number = F.array_position(F.array(*[F.lit(x) for x in languages]) if languages else F.array().cast("array<string>"), F.col("lang")) - 1
    own = counts.join(totals, "lang").filter(F.col("n") >= F.col("total") * SHARE).select("gram", number.alias("number"))
    bits = own.select(
        "gram", F.floor(F.col("number") / 64).cast("long").alias("word"),
        F.expr("shiftleft(1L, cast(number % 64 as int))").alias("mask"),
    )
    filled = bits.mapInArrow(_slots, "slot long, word long, mask long").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask"))
    table = np.zeros((1 << LOG2_SLOTS, max(1, -(-len(languages) // 64))), np.uint64)
    cells = filled.toArrow()
    if cells.num_rows:
        table[cells["slot"].to_numpy(), cells["word"].to_numpy()] = cells["mask"].to_numpy().view(np.uint64)
    counts.unpersist()
    return Filters(languages, table)


def _has_letter(column, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letter = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data >= 0x61) & (data <= 0x7A), out=ascii_letter[1:])
    found = np.diff(ascii_letter[offsets]) > 0
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)).tolist():
        found[i] = any(c.isalpha() for c in column[i].as_py())
    return found


def _judge(column, known: Filters) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Predicted languages, scores, and numbers of n-grams of a column of texts."""
    column = _lower(column)
    data, offsets = text_column(column)
    letters = np.zeros(len(column), bool)
    best, score, n_grams = np.zeros(len(column), np.int64), np.zeros(len(column)), np.zeros(len(column), np.int64)
    for first, end, part, own in slices(data, offsets, AT_ONCE):
        letters[first:end] = _has_letter(column.slice(first, end - first), part, own)
        if known.languages:
            n, held = known.counts(part, own)
            best[first:end], n_grams[first:end] = held.argmax(1), n
            score[first:end] = (held.max(1) / n.clip(1)).clip(0, 1)
    names = pa.array([*known.languages, "und"], pa.string())
    best = np.where(letters & (len(known.languages) > 0), best, len(known.languages))
    return names.take(pa.array(best)), np.where(best < len(known.languages), score, 0.0), n_grams


def prediction(docs: DataFrame, filters: Filters):
    """A function from a text column to (lang_pred, score, n_grams); without an n-gram the score is no evidence."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(filters)

    @F.arrow_udf("struct<lang_pred:string,score:double,n_grams:long>")
    def judged(texts: pa.Array) -> pa.Array:
        names, scores, n_grams = _judge(texts, shared.value)
        return pa.StructArray.from_arrays([names, pa.array(scores), pa.array(n_grams)], ["lang_pred", "score", "n_grams"])

    return judged


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score."""
    judged = prediction(docs, filters)(F.col("text").cast("string"))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), judged.alias("judged"))
    return rows.select("doc_id", "held_out", "judged.lang_pred", "judged.score")
