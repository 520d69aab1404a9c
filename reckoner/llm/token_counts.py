"""Token counts of whole texts through a digest cache.

The cache is a table on shared files: for a tokenizer version, the digest of a
text and its number of tokens. A run digests the texts, joins them to the
cache, encodes each distinct text that is missing once, appends the counts, and
reads all counts from the cache. The version is the digest of the vocabulary
file with the library's name and version, so no count outlives its tokenizer.

Normalised content is the text itself, with NULL as the empty text: any other
change could change the count.

Encoding works on pieces: a text is cut wherever a character that is not white
space is followed by white space. The pre-tokenizers supported (byte-level
without a prefix blank) never join across such a place, so counts add up, and a
task encodes a piece once however often it occurs. Pieces are kept in a table
of bounded size.

Rows of one digest are reduced to a smallest row hash before texts are joined
to misses, so copies, however many, spread over all tasks and their texts are
not gathered. Texts are shuffled once, and not at all where misses are few.

Cases: NULL and empty texts have no tokens. Repeated rows are each counted.
Special strings in a text are what the library makes of them by default.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckoner.llm.shared import ship, written

PIECE = re.compile(r"\s*\S+|\s+")
PIECES_KEPT = 300_000
LONGEST_KEPT = 40
CACHE = "digest binary, n_tokens long"


def version_of(path: str) -> str:
    """Digest of the vocabulary file and of the library that reads it."""
    import tokenizers

    with open(path, "rb") as file:
        content = file.read()
    return hashlib.sha256(f"tokenizers {tokenizers.__version__}\n".encode() + content).hexdigest()


class PieceCounter:
    """Numbers of tokens of texts, by their pieces."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        known, totals = self.known, []
        if len(known) > PIECES_KEPT:
            known.clear()
        for text in texts:
            pieces = PIECE.findall(text)
            missing = list({p for p in pieces if p not in known})
            own = {}
            if missing:
                encoded = self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)
                own = {p: len(e.ids) for p, e in zip(missing, encoded, strict=True)}
                known.update((p, n) for p, n in own.items() if len(p) <= LONGEST_KEPT)
            totals.append(sum(own[p] if p in own else known[p] for p in pieces))
        return totals


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    counter = PieceCounter(path)
    for batch in batches:
        counts = counter.counts(batch.column(1).to_pylist())
        yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])


def cached(df_session, cache: str, version: str) -> DataFrame:
    """What the cache holds for a version, each digest once; empty if there is no cache yet."""
    try:
        rows = df_session.read.schema(CACHE).parquet(f"{cache}/version={version}")
    except AnalysisException:
        return df_session.createDataFrame([], CACHE)
    return rows.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens; what was missing is appended to ``cache``."""
    spark, version = docs.sparkSession, version_of(tokenizer_path)
    ship(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    digest, row_hash = F.unhex(F.sha2(F.col("text").cast("binary"), 256)), F.xxhash64("doc_id")
    keyed = written(
        rows.select("doc_id", digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes")), "digests"
    )
    chosen = keyed.groupBy("digest").agg(F.min(row_hash).alias("row_hash"))
    missing = chosen.join(cached(spark, cache, version), "digest", "left_anti")
    texts = rows.select(digest.alias("digest"), row_hash.alias("row_hash"), "text")
    texts = texts.join(missing, ["digest", "row_hash"], "left_semi").select("digest", "text")
    new = texts.mapInArrow(lambda batches: _encode(batches, tokenizer_path), CACHE)
    new.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")).write.mode("append").parquet(
        f"{cache}/version={version}"
    )
    counts = written(cached(spark, cache, version), "counts")
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")
