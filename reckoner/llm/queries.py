"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reckoner.llm import chat, collocations, context_tree, decontaminate, exact_dedup, language, merkle, minhash, mixing, quality, repeats, token_counts, toxicity
from reckoner.llm.shared import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_classes(table(spark, sf_dir, "documents")).drop("row_id", "text_key")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every call starts a cache of its own, so each distinct text is encoded."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), path, new_folder(spark, "token-cache"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")), 0.3)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")), 0.5)


# Fixed value: a text made of the template's control strings.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], turns.schema)
    return chat.digest(chat.format_chats(chat.events_of_turns(turns.unionAll(control))))


def op9_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("row_id", "text_key")


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_token_counts": op2_token_counts,
    "op3_mixing": op3_mixing,
    "op4_decontaminate": op4_decontaminate,
    "op5_language": op5_language,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_chat": op8_chat,
    "op9_context_tree": op9_context_tree,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_repeats": op11_repeats,
    "op12_collocations": op12_collocations,
    "op13_merkle": op13_merkle,
}
