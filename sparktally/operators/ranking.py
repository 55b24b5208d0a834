"""Top-k, per-group top-k and a distributed rank()."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql import types as T

from sparktally.session import ensure_checkpoint_dir

# Beyond this k Spark no longer limits a window's groups before the shuffle.
GROUP_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_k(df: DataFrame, order: Sequence[Column], k: int | None) -> DataFrame:
    """Rows in order, the first k when k is given.  End `order` with the key."""
    ordered = df.orderBy(*order)
    return ordered if k is None else ordered.limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    rank_name: str = "rk", spread: str | None = None,
                    salts: int | None = None) -> DataFrame:
    """The first k rows of every group, numbered from 1.

    Up to Spark's group-limit threshold each task passes on at most k rows
    per group.  Beyond it, hot groups are first cut to k rows within `salts`
    sub-groups, as many as shuffle partitions if not given, by a hash of column
    `spread`; the first k of a group are among the first k of its sub-groups,
    so the result is exact.
    """
    spark = df.sparkSession
    salts = salts or shuffle_width(spark)
    threshold = int(spark.conf.get(GROUP_LIMIT_CONF, "1000"))
    if k > threshold and spread is not None:
        part = F.pmod(F.xxhash64(spread), F.lit(salts))
        inner = W.partitionBy(*group, part).orderBy(*order)
        df = df.withColumn("_rk", F.row_number().over(inner)).where(F.col("_rk") <= k).drop("_rk")
    window = W.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(window)).where(F.col(rank_name) <= k)


def nest_top(df: DataFrame, group: Sequence[str], columns: Sequence[str], name: str,
             rank_name: str = "rk") -> DataFrame:
    """Rows numbered by `top_k_per_group` as one array of structs per group, in rank order."""
    listed = F.sort_array(F.collect_list(F.struct(rank_name, *columns)))
    plain = F.transform(listed, lambda s: F.struct(*[s[c].alias(c) for c in columns]))
    return df.groupBy(*group).agg(plain.alias(name))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rank_values(df: DataFrame, value: str, rank_name: str, buckets: int | None = None) -> DataFrame:
    """(value, rank) for every distinct value, as rank() over value descending.

    rank = 1 + rows with a greater value.  Rows are counted per distinct value,
    the distinct values are cut into ranges by pivots, as many as shuffle
    partitions if `buckets` is not given, and a value's rank is the total of
    the higher ranges plus a running total inside its own, so no task holds
    more than one range.  A value finds its range by binary search.  The pivots are the values with the
    smallest hashes: a sample that is fixed by the data, so that a recomputed
    task sees the same ranges.  Any pivots give exact ranks.
    """
    buckets = buckets or shuffle_width(df.sparkSession)
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_rows"))
    # Several sampled values per range even out the range sizes.
    per_range = 8
    sample = (counts.where(F.col("_rows") > 0).select(value)
              .orderBy(F.xxhash64(value), value).limit(buckets * per_range))
    pivots = sample.agg(F.sort_array(F.collect_list(value)).alias("_p")).select(
        F.filter("_p", lambda v, i: i % per_range == per_range - 1).alias("_p"))
    # Ranges are numbered from the highest values; null sorts last.  The
    # coalesce tells Spark that a range is never null, so that no null check
    # on it is pushed down to the rows.
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(buckets.bit_length()))])
    up_to = F.aggregate(steps, F.lit(0), lambda below, step: F.when(
        F.get("_p", below + step - 1) <= F.col(value), below + step).otherwise(below))
    higher_pivots = F.size("_p") - up_to
    ranged = counts.withColumn("_p", pivots.scalar()).withColumn(
        "_range",
        F.coalesce(F.when(F.col(value).isNotNull(), higher_pivots), F.lit(buckets + 1))).drop("_p")
    # At most buckets + 2 rows from here, whatever the size of the data.
    totals = ranged.groupBy("_range").agg(F.sum("_rows").alias("_range_rows"))
    above = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "_range", F.coalesce(F.sum("_range_rows").over(above), F.lit(0)).alias("_offset"))
    higher = (W.partitionBy("_range").orderBy(F.desc(value))
              .rowsBetween(W.unboundedPreceding, -1))
    return (ranged.withColumn("_higher", F.coalesce(F.sum("_rows").over(higher), F.lit(0)))
            .join(F.broadcast(offsets), "_range")
            .select(value, (F.col("_offset") + F.col("_higher") + 1).alias(rank_name)))


def attach_rank(df: DataFrame, ranks: DataFrame, value: str) -> DataFrame:
    """`df` with the rank of its value from `rank_values`."""
    ranks = ranks.withColumnRenamed(value, "_value")
    return df.join(ranks, F.col(value).eqNullSafe(F.col("_value")), "left").drop("_value")


def global_rank(df: DataFrame, value: str, rank_name: str, buckets: int | None = None) -> DataFrame:
    """`df` with rank() over `value` descending, without a single-task window.

    Ranks are matched to rows by value.  A floating sum may differ in its last
    bit when recomputed, so such a frame is checkpointed first; whole numbers
    need no such cut.
    """
    if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)):
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint()
    return attach_rank(df, rank_values(df, value, rank_name, buckets), value)
