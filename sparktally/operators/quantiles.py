"""Exact quantiles and tiles over a whole table, and quantile sketches that can be kept and merged."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

from sparktally.operators.ranking import attach_rank, rank_values
from sparktally.session import ensure_checkpoint_dir

#: Size of a sketch: with 800 the rank of a quantile is off by about 0.35 % of the rows.
SKETCH_K = 800


def _fixed(df: DataFrame) -> DataFrame:
    """`df` written once: a floating sum may differ in its last bit when it is computed again."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _total(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def ntile(df: DataFrame, order: Sequence[str], tiles: int, name: str = "tile") -> DataFrame:
    """`df` with ntile(tiles) over the ascending order of the columns, which together name a row; nulls first.

    Rows are numbered by `rank_values` over the columns as one value: in ranges that the data fix,
    so a value that a third of the rows share is spread over many of them.
    """
    rows = _fixed(df.withColumn("_at", F.struct(*order)))
    n = _total(rows)
    placed = attach_rank(rows, rank_values(rows, "_at", "_rank"), "_at")
    place, small, large = n - F.col("_rank"), F.floor(n / tiles), n % tiles
    # The first `large` tiles have a row more than the others.
    tile = F.when(place < large * (small + 1), F.floor(place / (small + 1))).otherwise(
        large + F.floor((place - large * (small + 1)) / F.greatest(small, F.lit(1))))
    return placed.withColumn(name, (tile + 1).cast("int")).drop("_at", "_rank")


def quantile_cuts(df: DataFrame, value: str, shares: Sequence[float]) -> DataFrame:
    """One row: for each share the smallest value that at least that share of the rows does not exceed.

    Columns cut_0, cut_1, ...; null values do not count, without any other value cuts are null.
    A value is that quantile if no more rows lie above it than the share leaves, and ranks
    say how many do; so no task sorts or holds the column.
    """
    rows = _fixed(df.where(F.col(value).isNotNull()).select(value))
    ranks = rank_values(rows, value, "_rank").withColumn("_all", _total(rows))
    cuts = []
    for i, share in enumerate(shares):
        exact = Fraction(share)  # whole numbers, as a product of doubles may lie above its row
        needed = F.greatest(F.expr(f"(_all * {exact.numerator}L + {exact.denominator - 1}L) div {exact.denominator}L"), F.lit(1))
        cuts.append(F.min(F.when(F.col("_rank") - 1 <= F.col("_all") - needed, F.col(value))).alias(f"cut_{i}"))
    return ranks.agg(*cuts)


def level(value: Column, cuts: DataFrame) -> Column:
    """How many of the cuts the value exceeds."""
    above = [F.coalesce((value > cuts.select(c).scalar()).cast("int"), F.lit(0)) for c in cuts.columns]
    return sum(above[1:], above[0])


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """keys, sketch of the value per key: to be kept, and merged with `merge_quantiles`."""
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def merge_quantiles(sketches: DataFrame, keys: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """keys, share, n, quantile: approximate quantiles of all rows behind the sketches of a key."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("_merged"))
    found = [F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("_merged", F.lit(float(s))).alias("quantile"))
             for s in shares]
    return merged.select(*keys, F.kll_sketch_get_n_double("_merged").alias("n"), F.inline(F.array(*found))).select(
        *keys, "share", "n", "quantile")
