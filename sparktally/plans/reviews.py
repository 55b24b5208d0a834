"""Review text analyses.

reviews(id, review, category, aspect, sentiment); stop-words are a list of
strings or a one-column DataFrame.  A count over a group counts the rows
whose first column is not null, and a null group is a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sparktally.functions.text import TOKEN_DELIMITERS
from sparktally.operators.aggregates import count_by
from sparktally.operators.ranking import nest_top, top_k_per_group
from sparktally.operators.terms import frequent_terms, term_frequency, tfidf, words_of

StopWords = Sequence[str] | DataFrame
POLAR = ("positive", "negative")


def clean_review_tokens(reviews: DataFrame, stop_words: StopWords,
                        delimiters: str = TOKEN_DELIMITERS) -> DataFrame:
    """review_id, word: one row per remaining word of every review."""
    return (words_of(reviews, "review", ["id"], stop_words, delimiters)
            .withColumnRenamed("id", "review_id"))


def frequent_words(reviews: DataFrame, stop_words: StopWords, threshold: int = 500,
                   delimiters: str = TOKEN_DELIMITERS) -> DataFrame:
    """word, freq of the words seen more than `threshold` times, most frequent first."""
    counts = term_frequency(words_of(reviews, "review", [], stop_words, delimiters))
    return frequent_terms(counts, threshold).orderBy(F.desc("freq"), F.asc("word"))


def reviews_by_category(reviews: DataFrame, distinct_by: str | None = None) -> DataFrame:
    """category, n; `distinct_by='id'` counts distinct ids instead of rows."""
    return count_by(reviews, ["category"], distinct_by or "id", distinct=distinct_by is not None)


def reviews_by_aspect(reviews: DataFrame, distinct_by: str | None = None) -> DataFrame:
    """aspect, n"""
    return count_by(reviews, ["aspect"], distinct_by or "id", distinct=distinct_by is not None)


def _aspect_counts(reviews: DataFrame, sentiments: Sequence[str]) -> DataFrame:
    rated = reviews.where(F.col("sentiment").isin(*sentiments))
    return count_by(rated, ["aspect", "sentiment"], "id")


def aspect_sentiment_ranking(reviews: DataFrame, sentiments: Sequence[str] = POLAR) -> DataFrame:
    """aspect, sentiment, n: every aspect, most reviews first within a sentiment."""
    return _aspect_counts(reviews, sentiments).orderBy(
        F.asc("sentiment"), F.desc("n"), F.asc("aspect"))


def top_aspect_by_sentiment(reviews: DataFrame, k: int = 1,
                            sentiments: Sequence[str] = POLAR) -> DataFrame:
    """aspect, sentiment, n of the k aspects with most reviews per sentiment."""
    counts = _aspect_counts(reviews, sentiments)
    top = top_k_per_group(counts, ["sentiment"], [F.desc("n"), F.asc("aspect")], k, spread="aspect")
    return top.drop("rk")


def top_words(reviews: DataFrame, stop_words: StopWords, group: Sequence[str], k: int = 5,
              delimiters: str = TOKEN_DELIMITERS) -> DataFrame:
    """group..., word, freq, rk: the k most frequent words of every group."""
    counts = term_frequency(words_of(reviews, "review", group, stop_words, delimiters), group)
    return top_k_per_group(counts, group, [F.desc("freq"), F.asc("word")], k, spread="word")


def top_words_by_category_sentiment(reviews: DataFrame, stop_words: StopWords, k: int = 5,
                                    sentiments: Sequence[str] = POLAR) -> DataFrame:
    """category, sentiment, top_words: array of (word, freq).

    Filter on sentiment, or write with `write_split`, for one output each.
    """
    rated = reviews.where(F.col("sentiment").isin(*sentiments))
    group = ["category", "sentiment"]
    return nest_top(top_words(rated, stop_words, group, k), group, ["word", "freq"], "top_words")


def top_words_by_category(reviews: DataFrame, stop_words: StopWords, k: int = 5) -> DataFrame:
    """category, top_words: array of (word, freq)."""
    return nest_top(top_words(reviews, stop_words, ["category"], k),
                    ["category"], ["word", "freq"], "top_words")


def top_words_by_category_aspect_sentiment(reviews: DataFrame, stop_words: StopWords,
                                           k: int = 5) -> DataFrame:
    """category, aspect, sentiment, word, freq: flat rows, every sentiment."""
    return top_words(reviews, stop_words, ["category", "aspect", "sentiment"], k).drop("rk")


def tfidf_top_words(reviews: DataFrame, stop_words: StopWords, k: int = 5,
                    group: Sequence[str] = ("category", "aspect"),
                    delimiters: str = TOKEN_DELIMITERS) -> DataFrame:
    """group..., word, tf, tfidf: the k highest-scored words of every group."""
    scores = tfidf(words_of(reviews, "review", list(group), stop_words, delimiters), list(group))
    order = [F.desc("tfidf"), F.asc("word")]
    return top_k_per_group(scores, list(group), order, k, spread="word").drop("rk")
