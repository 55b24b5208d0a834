"""Words, word frequencies and TF-IDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sparktally.functions.text import TOKEN_DELIMITERS, token_array
from sparktally.operators.joins import exclude_terms


def words_of(df: DataFrame, text: str, keep: Sequence[str], stop_words: Sequence[str] | DataFrame,
             delimiters: str = TOKEN_DELIMITERS, word: str = "word") -> DataFrame:
    """One row per word that is not a stop-word; a null or empty text gives none."""
    rows = (df.select(*keep, F.explode(token_array(F.col(text), delimiters)).alias(word))
            .where(F.col(word) != ""))
    return exclude_terms(rows, word, stop_words).select(*keep, word)


def term_frequency(words: DataFrame, group: Sequence[str] = (), word: str = "word",
                   freq: str = "freq") -> DataFrame:
    """Occurrences per (group, word); counts rows whose first column is not null."""
    first = group[0] if group else word
    return words.groupBy(*group, word).agg(F.count(first).alias(freq))


def frequent_terms(counts: DataFrame, threshold: int, freq: str = "freq") -> DataFrame:
    """Words above the threshold (strict)."""
    return counts.where(F.col(freq) > threshold)


def tfidf(words: DataFrame, group: Sequence[str], word: str = "word") -> DataFrame:
    """group..., word, tf, tfidf with every group as one document.

    tf = share of the group's words, idf = ln(groups / groups with the word).
    The word counts are small against the words; group totals and document
    frequencies are aggregated from them and joined back.  All three branches
    ask for the same columns, so Spark runs the one shuffle of the words and
    reuses it.
    """
    counts = (words.where(F.col(word).isNotNull())
              .groupBy(*group, word).agg(F.count(F.lit(1)).alias("_count")))
    totals = (counts.groupBy(*[F.col(g).alias(f"_{g}") for g in group])
              .agg(F.sum("_count").alias("_size")))
    # Summing _count keeps that column in this branch's shuffle too.  Grouped
    # by a hash as well, the branch is shuffled once more for the join on the
    # word, which lets AQE split the partition of a word that is everywhere.
    documents = (counts.groupBy(F.col(word).alias("_word"), F.xxhash64(word).alias("_hash"))
                 .agg(F.count("_count").alias("_df"), F.sum("_count").alias("_all")).drop("_hash"))
    n_groups = totals.agg(F.count("_size"))
    same_group = F.lit(True)
    for g in group:
        same_group = same_group & F.col(g).eqNullSafe(F.col(f"_{g}"))
    tf = F.col("_count") / F.col("_size")
    idf = F.ln(n_groups.scalar() / F.col("_df"))
    return (counts.join(totals, same_group)
            .join(documents, F.col(word) == F.col("_word"))
            .where(F.col("_all") >= F.col("_count"))
            .select(*group, word, tf.alias("tf"), (tf * idf).alias("tfidf")))
