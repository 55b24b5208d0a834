"""Exact quantiles and tiles against sorting, and sketches against exact figures."""

import math
import random

import plans
import pytest
from pyspark.sql import Window, functions as F

from sparktally.operators import distinct_sketches as ds, quantiles as q


def table(spark, seed, n):
    rng = random.Random(seed)
    values = [rng.choice([None, 1.5, 2.5, rng.random(), 7.0, 7.0, 7.0]) for _ in range(n)]
    return values, spark.createDataFrame(list(enumerate(values)), "id int, v double").repartition(5)


@pytest.mark.parametrize("n,tiles", [(0, 3), (1, 4), (3, 4), (101, 4), (240, 7)])
def test_tiles_equal_the_window(spark, n, tiles):
    _, df = table(spark, n, n)
    got = q.ntile(df, ["v", "id"], tiles)
    want = df.withColumn("tile", F.ntile(tiles).over(Window.orderBy(F.asc_nulls_first("v"), "id")))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 10, 333])
def test_cuts_equal_sorting(spark, n):
    values, df = table(spark, n + 50, n)
    known = sorted(v for v in values if v is not None)
    shares = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.9, 1.0]
    from fractions import Fraction
    want = [known[max(1, math.ceil(Fraction(s) * len(known))) - 1] if known else None for s in shares]
    assert list(q.quantile_cuts(df, "v", shares).first()) == want


def test_no_task_sorts_the_whole_table(spark, big):
    df = spark.range(2000).selectExpr("id", "id % 7 AS v")
    got = q.ntile(df, ["v", "id"], 4)
    got.collect()
    assert "SinglePartition" not in "\n".join(
        line for line in got._jdf.queryExecution().executedPlan().toString().split("\n") if "Window" in line or "Sort" in line)


def test_sketches_merge(spark):
    df = spark.range(20_000).selectExpr("id % 12 AS month", "double(id * 7919 % 20011) AS v")
    kept = q.quantile_sketches(df, ["month"], "v")
    for r in q.merge_quantiles(kept, [], [0.1, 0.5, 0.9]).collect():
        rank = df.where(F.col("v") <= r.quantile).count() / 20_000
        assert r.n == 20_000 and abs(rank - r.share) < 0.02


def test_distinct_counts_roll_up_without_the_rows(spark, tmp_path):
    rows = spark.range(50_000).selectExpr("id % 24 AS month", "id % 5 AS country", "id % 9000 AS key")
    for load in range(2):  # the second load repeats keys of the first
        ds.distinct_sketches(rows.where(f"id % 2 = {load}") if load else rows, ["month", "country"], "key").write.mode(
            "append").parquet(str(tmp_path))
    kept = spark.read.parquet(str(tmp_path))
    united = ds.distinct_estimates(kept, ["country"])
    exact = {r.country: r.n for r in rows.groupBy("country").agg(F.countDistinct("key").alias("n")).collect()}
    for r in united.collect():
        assert abs(r.n - exact[r.country]) <= 4 * ds.standard_error() * exact[r.country] + 1
    assert plans.executed(united)["FileSourceScanExec"] == 1 and len(exact) == 5
    assert abs(ds.distinct_estimates(kept, []).first().n - 9000) <= 4 * ds.standard_error() * 9000
