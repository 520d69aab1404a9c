"""A corpus pipeline over the documents.

Stages: language ID, exact dedup, MinHash near-dedup, benchmark decontamination,
mixing. Each takes what its predecessor kept, with all columns, and its
decisions take effect; all but the last return the columns of documents. The
last returns a row for each copy that the mix takes, with its ``copy`` number.

Rows are found again by id and a hash of the text; rows equal in both are told
apart only where just one of them stays. Cases are those of the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reckoner.llm import decontaminate, exact_dedup, language, minhash, mixing
from reckoner.llm.shared import written

# The share of its n-grams that the language of a kept document must hold, if it has any.
KNOWN_SHARE = 0.3


def text_key(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


def staying(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``kept`` names by doc_id and text_key, as often as it names them.

    ``kept`` may name a row of several equal ones; then one of them stays.
    """
    named = kept.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.count("*").alias("_n"))
    there = docs.groupBy("doc_id", text_key(F.col("text")).alias("text_key")).agg(F.count("*").alias("_rows"))
    named = named.join(
        there, F.col("_id").eqNullSafe(F.col("doc_id")) & F.col("_key").eqNullSafe(F.col("text_key"))
    ).select("_id", "_key", "_n", "_rows")
    named = written(named, "staying")
    found = docs.withColumn("_text_key", text_key(F.col("text"))).join(
        named, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_text_key").eqNullSafe(F.col("_key"))
    )
    every = found.filter("_n >= _rows").select(docs.columns)
    if named.filter("_n < _rows").isEmpty():
        return every
    some = found.filter("_n < _rows").withColumn("_nth", F.row_number().over(Window.partitionBy("_id", "_key").orderBy("_n")))
    return every.unionByName(some.filter("_nth <= _n").select(docs.columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no learned language, go."""
    filters = language.learn(docs)
    judged = docs.withColumn("_language", language.prediction(docs, filters)(F.col("text").cast("string")))
    foreign = (F.col("_language.n_grams") > 0) & (F.col("_language.score") < KNOWN_SHARE)
    known = (F.col("_language.lang_pred") != "und") & ~foreign
    return judged.filter(known).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each exact text stays."""
    return staying(docs, exact_dedup.exact_dedup(docs).filter("kept").select("doc_id", "text_key"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return staying(docs, minhash.near_classes(docs).filter("kept").select("doc_id", "text_key"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return staying(docs, decontaminate.decontaminate(docs, items).filter("n_hit = 0").select("doc_id", "text_key"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    copies = mixing.copies_of_rows(docs)
    return copies.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*docs.columns, "copy")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# Learned languages, sampled buckets and dealt copies are not SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over what its predecessor kept, written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
