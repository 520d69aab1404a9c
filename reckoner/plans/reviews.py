"""Analyses of reviews: clean words, counts, extremes and top words.

``reviews`` holds id, review, category, aspect, sentiment; ``stop_words`` one
column of words. Words are counted before stop words are removed wherever only
counts are needed: a long list, which has to be shuffled, then meets distinct
words instead of tokens. A short list is broadcast, and Spark moves that anti
join below the count by itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckoner.operators.aggregate import count_of
from reckoner.operators.enrich import not_listed
from reckoner.operators.filters import equal_to, more_than
from reckoner.operators.rank import best_one, best_with_ties, nest_top_k, top_k_per_group
from reckoner.operators.tokens import explode_words

# The sentiment labels that are reported on.
POSITIVE = "positive"
NEGATIVE = "negative"


def clean_words(reviews: DataFrame, stop_words: DataFrame) -> DataFrame:
    """(id, word) for every lower-case word that is no stop word; repeats kept."""
    words = explode_words(reviews, "review", ["id"])
    return not_listed(words, "word", stop_words).select("id", "word")


def word_frequency(reviews: DataFrame) -> DataFrame:
    """Occurrences of every word, stop words included; reviews without id do not count."""
    words = explode_words(reviews, "review", ["id"])
    return count_of(words, ["word"], "id", "total_words")


def frequent_words(reviews: DataFrame, more: int = 500) -> DataFrame:
    """Words with more than ``more`` occurrences."""
    return more_than(word_frequency(reviews), "total_words", more)


def reviews_by(reviews: DataFrame, column: str) -> DataFrame:
    """Reviews with an id per category or aspect; a missing one is its own group."""
    return count_of(reviews, [column], "id", "total_reviews")


def _aspect_counts(reviews: DataFrame, sentiment: str) -> DataFrame:
    return count_of(equal_to(reviews, "sentiment", sentiment), ["aspect"], "id", "cnt")


def top_aspects(reviews: DataFrame, sentiment: str) -> DataFrame:
    """Every aspect that shares the highest count of the sentiment."""
    return best_with_ties(_aspect_counts(reviews, sentiment), "cnt")


def top_aspect(reviews: DataFrame, sentiment: str) -> DataFrame:
    """One aspect with the highest count of the sentiment, the first by name among ties."""
    return best_one(_aspect_counts(reviews, sentiment), "cnt", "aspect")


def aspect_sentiment_counts(reviews: DataFrame) -> DataFrame:
    """Reviews with an id per aspect and sentiment, for several extremes of one scan."""
    return count_of(reviews, ["aspect", "sentiment"], "id", "cnt")


def top_of_counts(counts: DataFrame, sentiment: str, ties: bool = True) -> DataFrame:
    """As ``top_aspects`` or, without ``ties``, ``top_aspect``, from counts made before."""
    chosen = equal_to(counts, "sentiment", sentiment).select("aspect", "cnt")
    return best_with_ties(chosen, "cnt") if ties else best_one(chosen, "cnt", "aspect")


def _clean_counts(reviews: DataFrame, stop_words: DataFrame, groups: Sequence[str]) -> DataFrame:
    words = explode_words(reviews, "review", groups)
    return not_listed(count_of(words, [*groups, "word"], "category", "cnt"), "word", stop_words)


def top_words(reviews: DataFrame, stop_words: DataFrame, k: int = 5, sentiment: str | None = None) -> DataFrame:
    """The k most frequent words per category that are no stop words, ranked."""
    chosen = reviews if sentiment is None else equal_to(reviews, "sentiment", sentiment)
    counts = _clean_counts(chosen, stop_words, ["category"])
    return top_k_per_group(counts, ["category"], "cnt", "word", k).select("category", "rank", "word", "cnt")


def top_words_by_sentiment(
    reviews: DataFrame, stop_words: DataFrame, sentiments: Sequence[str] = (POSITIVE, NEGATIVE), k: int = 5
) -> DataFrame:
    """``top_words`` of several sentiments from one scan, with the sentiment in front."""
    chosen = reviews.filter(F.col("sentiment").isin(*sentiments))
    counts = _clean_counts(chosen, stop_words, ["sentiment", "category"])
    top = top_k_per_group(counts, ["sentiment", "category"], "cnt", "word", k)
    return top.select("sentiment", "category", "rank", "word", "cnt")


def nested_top_words(top: DataFrame) -> DataFrame:
    """One row per category with its ranked (category, word, cnt) entries as an array."""
    entries = top.withColumn("entry_category", F.col("category"))
    nested = nest_top_k(entries, "category", ["entry_category", "word", "cnt"], "top_words")
    return nested.withColumn(
        "top_words", F.col("top_words").cast("array<struct<category:string,word:string,cnt:bigint>>")
    )
