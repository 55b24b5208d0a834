"""Dimension joins and word-list exclusion.

Equi-joins carry no broadcast hint: Spark broadcasts a side whose statistics
or measured shuffle size are under its threshold, and otherwise sorts and
merges, with AQE splitting the partitions of hot keys.

AQE splits a hot partition only where both inputs of the join come straight
from a shuffle.  A side that was just aggregated by the join key comes from
its aggregation instead, so joins whose other side can be hot pass such a
side through `own_shuffle`.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def unique_dim(dim: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest of its duplicates.

    `min` of a struct combines map-side, so a key with very many duplicates
    never gathers in one task.
    """
    others = [c for c in dim.columns if c != key]
    if not others:
        return dim.distinct()
    return dim.groupBy(key).agg(F.min(F.struct(*others)).alias("_row")).select(key, "_row.*")


def own_shuffle(df: DataFrame, key: str) -> DataFrame:
    """`df` with its key recomputed, so that a join on it shuffles `df` again.

    Costs one exchange of an aggregated side, nothing where the side is
    broadcast or would be shuffled anyway.
    """
    return df.withColumn(key, F.element_at(F.array(key), 1))


def lookup(facts: DataFrame, dim: DataFrame, key: str, how: str = "inner",
           dedupe_dim: bool = False, fallback: dict[str, Column] | None = None,
           hot_keys: bool = False) -> DataFrame:
    """Equi-join of facts to a dimension that is unique on `key`.

    `dedupe_dim` makes it unique first.  With `how='left'`, `fallback` names
    the value of a column where no dimension row matched.  `hot_keys` is for
    facts that are not reduced by the key: one key may hold any share of them.
    """
    side = unique_dim(dim, key) if dedupe_dim else dim
    if hot_keys:
        side = own_shuffle(side, key)
    joined = facts.join(side, key, how)
    for name, value in (fallback or {}).items():
        joined = joined.withColumn(name, F.coalesce(F.col(name), value))
    return joined


def exclude_terms(words: DataFrame, column: str, terms: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose word is not in the list; a null word is in no list and stays.

    One anti join for a Python list and for a DataFrame of one string column.
    Nothing is run or measured here: Spark broadcasts a list that is under its
    threshold, and else splits the partition of a hot word.
    """
    if not isinstance(terms, DataFrame):
        # An Arrow table becomes a local relation, whose size Spark knows while it plans.
        listed = pa.table({column: pa.array(sorted(set(terms)), pa.string())})
        terms = words.sparkSession.createDataFrame(listed)
    listed = terms.select(F.col(terms.columns[0]).alias(column)).where(F.col(column).isNotNull())
    return words.join(own_shuffle(listed, column), column, "left_anti")
