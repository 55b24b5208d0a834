"""Means, counts and distinct totals.

Everything here aggregates with functions that combine map-side, so a key
holding a large share of the rows leaves each map task as one partial row.
Means that are joined to a dimension afterwards travel as (sum, count).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

TOTAL, COUNT = "_total", "_n"


def _mean(total: Column, n: Column, precision: str) -> Column:
    mean = F.try_divide(total, n)
    if precision == "float":
        return mean.cast("float")
    if precision == "double":
        return mean
    raise ValueError(f"unknown precision {precision!r}")


def partial_mean(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(sum, count) of the non-null values per key; keys with none are absent."""
    return (df.where(F.col(value).isNotNull())
            .groupBy(*keys)
            .agg(F.sum(value).alias(TOTAL), F.count(value).alias(COUNT)))


def merge_partials(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial means of a finer key rolled up to a coarser one."""
    return parts.groupBy(*keys).agg(F.sum(TOTAL).alias(TOTAL), F.sum(COUNT).alias(COUNT))


def finish_mean(parts: DataFrame, mean: str = "avg_rating", n: str | None = "n_ratings",
                precision: str = "double") -> DataFrame:
    keys = [c for c in parts.columns if c not in (TOTAL, COUNT)]
    columns = [_mean(F.col(TOTAL), F.col(COUNT), precision).alias(mean)]
    if n is not None:
        columns.append(F.col(COUNT).alias(n))
    return parts.select(*keys, *columns)


def mean_count(df: DataFrame, keys: Sequence[str], value: str, mean: str = "avg_rating",
               n: str = "n_ratings", precision: str = "double") -> DataFrame:
    return finish_mean(partial_mean(df, keys, value), mean, n, precision)


def pivot_partials(parts: DataFrame, keys: Sequence[str], label: Column,
                   outputs: dict[str, str], missing: float | None = None,
                   precision: str = "double") -> DataFrame:
    """One mean column per label, rolled up from partial means.

    `outputs` maps label to column name.  Labels not listed are ignored, but
    their key still gets a row.  A key without rows for a label gets `missing`.
    """
    sums = []
    for i, name in enumerate(outputs):
        hit = label == name
        sums.append(F.sum(F.when(hit, F.col(TOTAL))).alias(f"_t{i}"))
        sums.append(F.sum(F.when(hit, F.col(COUNT))).alias(f"_c{i}"))
    wide = parts.groupBy(*keys).agg(*sums)
    means = []
    for i, column in enumerate(outputs.values()):
        mean = _mean(F.col(f"_t{i}"), F.col(f"_c{i}"), precision)
        if missing is not None:
            mean = F.coalesce(mean, F.lit(missing).cast("float" if precision == "float" else "double"))
        means.append(mean.alias(column))
    return wide.select(*keys, *means)


def count_by(df: DataFrame, keys: Sequence[str], counted: str, n: str = "n",
             distinct: bool = False) -> DataFrame:
    """Rows per key whose `counted` column is not null.

    A null key is a group, and a group with only null `counted` keeps its
    row with 0.
    """
    tally = F.countDistinct(counted) if distinct else F.count(counted)
    return df.groupBy(*keys).agg(tally.alias(n))


def distinct_total(df: DataFrame, column: str, name: str, approximate: bool = False) -> DataFrame:
    """One row: number of distinct values, a null counting as one value."""
    tally = F.approx_count_distinct(column) if approximate else F.countDistinct(column)
    has_null = F.coalesce(F.max(F.col(column).isNull().cast("bigint")), F.lit(0))
    return df.agg((tally + has_null).cast("bigint").alias(name))
