import math
import random

import plans
import pytest
from conftest import rows
from pyspark.sql import Window as W, functions as F

from sparktally.operators import aggregates, joins, ranking, terms


def test_unique_dim_keeps_the_smallest_row(spark):
    dim = spark.createDataFrame([(1, "b", 1), (1, "a", 9), (2, None, 3)], "k int, v string, w int")
    assert rows(joins.unique_dim(dim, "k")) == [(1, "a", 9), (2, None, 3)]
    assert rows(joins.unique_dim(dim.select("k"), "k")) == [(1,), (2,)]


def test_lookup(spark):
    facts = spark.createDataFrame([(1, 5), (3, 6)], "k int, x int")
    dim = spark.createDataFrame([(1, "a"), (1, "b")], "k int, name string")
    assert rows(joins.lookup(facts, dim, "k", dedupe_dim=True)) == [(1, 5, "a")]
    named = joins.lookup(facts, dim, "k", "left", True, {"name": F.col("k").cast("string")})
    assert rows(named) == [(1, 5, "a"), (3, 6, "3")]


def test_exclude_terms_by_table(spark):
    words = spark.createDataFrame([(w,) for w in ["a", "b", "c", "b", "tại sao", None]], "word string")
    stop = spark.createDataFrame([("b",), ("b",), (None,), ("x",)], "stop string")
    got = joins.exclude_terms(words, "word", stop)
    assert rows(got) == sorted([("a",), ("c",), ("tại sao",), (None,)], key=repr)
    assert plans.executed(got)["BroadcastHashJoinExec"] == 1


@pytest.mark.parametrize("n", [0, 1, 10_001])
def test_exclude_terms_by_list_of_any_length(spark, big, n):
    words = spark.createDataFrame([("w0",), ("w10000",), (None,), ("other",)], "word string")
    listed = [f"w{i}" for i in range(n)]
    want = sorted([(w,) for w in ("w0", "w10000", None, "other") if w not in listed], key=repr)
    table = spark.createDataFrame([(w,) for w in [*listed, *listed[:3], None]], "t string")
    assert rows(joins.exclude_terms(words, "word", listed)) == want
    assert rows(joins.exclude_terms(words, "word", table)) == want


def test_means_ignore_nulls_and_keep_no_empty_key(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("b", None)], "k string, v double")
    assert rows(aggregates.mean_count(df, ["k"], "v")) == [("a", 1.5, 2)]


def test_float_means(spark):
    """3.725 and 3.775 round down and up once the mean is a 32-bit float."""
    df = spark.createDataFrame([("action", 74.5), ("crime", 75.5)], "k string, total double")
    many = df.select("k", F.explode(F.array_repeat(F.col("total") / 20, 20)).alias("v"))
    got = aggregates.mean_count(many, ["k"], "v", precision="float")
    text = got.select("k", F.format_string("%.2f", "avg_rating"))
    assert rows(text) == [("action", "3.72"), ("crime", "3.78")]


def test_count_by_null_rules(spark):
    df = spark.createDataFrame([(1, "x"), (None, "x"), (None, None), (1, "x")], "id int, g string")
    assert rows(aggregates.count_by(df, ["g"], "id")) == [("x", 2), (None, 0)]
    assert rows(aggregates.count_by(df, ["g"], "id", distinct=True)) == [("x", 1), (None, 0)]


def test_distinct_total_counts_null_once(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "id int")
    assert aggregates.distinct_total(df, "id", "n").first()[0] == df.distinct().count() == 3
    assert aggregates.distinct_total(df.limit(0), "id", "n").first()[0] == 0
    assert aggregates.distinct_total(df, "id", "n", approximate=True).first()[0] == 3


def _groups(spark, seed=5, n=600):
    rng = random.Random(seed)
    data = [(rng.choice(["hot"] * 6 + ["a", "b", None]), f"w{i}", rng.randrange(30)) for i in range(n)]
    return data, spark.createDataFrame(data, "g string, word string, freq int")


@pytest.mark.parametrize("k", [1, 5, 40])
def test_top_k_per_group(spark, conf, k):
    conf(**{"spark.sql.optimizer.windowGroupLimitThreshold": "10"})
    data, df = _groups(spark)
    order = [F.desc("freq"), F.asc("word")]
    got = ranking.top_k_per_group(df, ["g"], order, k, spread="word")
    want = []
    for g in {d[0] for d in data}:
        best = sorted((d for d in data if d[0] == g), key=lambda d: (-d[2], d[1]))[:k]
        want += [(*d, i) for i, d in enumerate(best, 1)]
    assert rows(got) == sorted(want, key=repr)
    windows = plans.executed(got)["WindowExec"]
    assert windows == (1 if k <= 10 else 2)


def test_nest_top_keeps_rank_order(spark):
    df = spark.createDataFrame([("g", i, f"w{i}", 100 - i) for i in range(1, 12)], "g string, rk int, word string, freq int")
    top = ranking.nest_top(df, ["g"], ["word", "freq"], "top").first()["top"]
    assert [tuple(t) for t in top] == [(f"w{i}", 100 - i) for i in range(1, 12)]


@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(12,2)"])
@pytest.mark.parametrize("buckets", [1, 7, 64, 1024, None])
def test_global_rank_equals_rank(spark, kind, buckets):
    rng = random.Random(buckets or 0)
    values = [None] * 20 + [7] * 400 + [rng.randrange(-300, 300) for _ in range(800)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int").select("id", F.col("v").cast(kind).alias("v"))
    got = ranking.global_rank(df, "v", "rk", buckets=buckets)
    want = df.withColumn("rk", F.rank().over(W.orderBy(F.col("v").desc_nulls_last())).cast("bigint"))
    assert rows(got) == rows(want)
    assert rows(ranking.global_rank(df.limit(0), "v", "rk")) == []


def test_rank_reads_its_input_once(spark, big, tmp_path):
    spark.range(5000).select("id", (F.col("id") % 997).alias("v")).write.parquet(str(tmp_path / "t"))
    ranked = ranking.global_rank(spark.read.parquet(str(tmp_path / "t")).groupBy("v").agg(F.count("id").alias("n")), "n", "rk")
    ranked.collect()
    seen = plans.executed(ranked)
    assert seen["FileSourceScanExec"] == 1


def test_tfidf_by_hand(spark):
    words = spark.createDataFrame(
        [("p", "x"), ("p", "x"), ("p", "y"), ("q", "x"), (None, "z")], "g string, word string")
    got = {(r.g, r.word): (r.tf, r.tfidf) for r in terms.tfidf(words, ["g"]).collect()}
    want = {("p", "x"): (2 / 3, 2), ("p", "y"): (1 / 3, 1), ("q", "x"): (1.0, 2), (None, "z"): (1.0, 1)}
    assert set(got) == set(want)
    for key, (tf, df) in want.items():
        assert got[key][0] == pytest.approx(tf)
        assert got[key][1] == pytest.approx(tf * math.log(3 / df))


def test_tfidf_properties(spark):
    data, df = _groups(spark, seed=9)
    words = df.select("g", F.concat(F.lit("w"), F.col("freq").cast("string")).alias("word"))
    scored = terms.tfidf(words, ["g"])
    for r in scored.groupBy("g").agg(F.sum("tf").alias("s"), F.min("tfidf").alias("m")).collect():
        assert r.s == pytest.approx(1.0)
        assert r.m >= 0
    everywhere = words.groupBy("word").agg((F.countDistinct("g") + F.max(F.isnull("g").cast("int"))).alias("n")).where("n = 4")
    assert {r[0] for r in scored.join(everywhere, "word").select("tfidf").distinct().collect()} <= {0.0}


def test_words_of(spark):
    df = spark.createDataFrame([(1, "The THE cat,"), (2, ""), (3, None), (4, "the")], "id int, text string")
    assert rows(terms.words_of(df, "text", ["id"], ["the"])) == [(1, "cat")]
    assert rows(terms.words_of(df, "text", [], [])) == [("cat",), ("the",), ("the",), ("the",)]


def test_frequent_terms_is_strict(spark):
    counts = spark.createDataFrame([("a", 500), ("b", 501)], "word string, freq int")
    assert rows(terms.frequent_terms(counts, 500)) == [("b", 501)]
