"""A training-data pipeline: toxicity, line dedup, near-duplicates, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's `docs`.  All but the last keep the
columns of `docs`, extra ones of any name included.  A table without rows gives
one without rows.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

import sparktally
from sparktally.llm import line_runs, mixing, pieces, simhash_tree, toxicity
from sparktally.session import scratch_path

# Executors need not have the package installed.
cloudpickle.register_pickle_by_value(sparktally)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon learned from the labels scores below one half.

    Null and empty texts have the score of a text without a match and stay; equal texts share their fate, whatever their id.
    """
    return toxicity.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that an earlier document holds; n_chars counts what is left.

    No row goes.  Null and empty texts stay as they are, rows of one doc_id are one document, rows without an id come last.
    """
    kept = line_runs.dedup_lines(docs)
    kept = kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked within 2 bits over 3-word shingles: that of the smallest doc_id.

    Texts without words, null ones included, have fingerprint zero and are one group.  Rows of equal id are told apart by
    their text, then by a hash of the whole row; of rows equal in all columns one stays.
    """
    return simhash_tree.keep_one(docs, shingle=3, max_bits=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix to the sources' weights takes it.

    A null source is a source.  Texts without words weigh nothing and are taken as often as others of their source; a
    source without any word is not taken.
    """
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every document of the mix, repeats included; null and empty texts have no ids."""
    return pieces.encode(docs)


STAGES = [("toxicity", reject_toxic), ("line_dedup", dedup_lines), ("simhash_near_dedup", near_duplicates),
          ("mixing", mix), ("sentencepiece", encode)]

#: No SQL: XXH64 fingerprints and the tokenizer are not expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written below the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
