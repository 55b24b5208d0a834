"""Distinct counts that roll up: sketches kept per fine key, united for coarser ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: 2**LG_K registers: counts are off by about 1.04 / sqrt(2**LG_K), 0.8 %.
LG_K = 14


def standard_error(lg_k: int = LG_K) -> float:
    return 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(df: DataFrame, keys: Sequence[str], counted: str, lg_k: int = LG_K) -> DataFrame:
    """keys, sketch of the distinct non-null values of `counted`; made map-side, so a hot key is one row per task."""
    text = F.col(counted).cast("string")
    return df.groupBy(*keys).agg(F.hll_sketch_agg(text, F.lit(lg_k)).alias("sketch"))


def distinct_estimates(sketches: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """keys, approximate number of distinct values behind all sketches of a key; reads sketches only.

    A value in several sketches counts once.  Sketches may come from any number of loads.
    """
    united = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name)
    return sketches.groupBy(*keys).agg(united) if keys else sketches.agg(united)
