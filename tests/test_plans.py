"""What the plans must look like at scale."""

import plans
import pytest
from pyspark.sql import functions as F

from sparktally import catalog
from sparktally.operators import aggregates, joins, ranking, terms
from sparktally.plans import commerce, movies

FOLDER = "/root/testdata/sf0.001"


def ran(spark, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    df.collect()
    return df, plans.executed(df)


def text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_filter_and_columns_reach_the_scan(spark, big):
    df, _ = ran(spark, "category_revenue")
    plan = text(df)
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double,l_tax:double>" in plan


@pytest.mark.parametrize("name", ["tfidf_top_words", "seller_ranking", "seller_ranking_all", "global_rank"])
def test_branches_share_one_scan(spark, big, name):
    _, seen = ran(spark, name)
    assert seen["FileSourceScanExec"] == 1 and seen["ReusedExchangeExec"] >= 3


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_query_multiplies_rows_or_leaves_the_jvm(spark, big, name):
    _, seen = ran(spark, name)
    assert seen["CartesianProductExec"] == seen["BroadcastNestedLoopJoinExec"] == 0
    python = sum(n for kind, n in seen.items() if "Python" in kind or "Arrow" in kind or "Pandas" in kind)
    # The images are drawn by one step, and scored by another.
    assert python == {"undecodable_frames": 1, "detect_people": 2}.get(name, 0)


def test_per_group_top_is_cut_before_the_shuffle(spark, big):
    _, seen = ran(spark, "top_words_by_category")
    assert seen["WindowGroupLimitExec"] == 2


def test_occupations_shuffle_the_ratings_by_user_once(spark, big, tmp_path):
    ratings = spark.range(10000).select((F.col("id") % 500).alias("user_id"), (F.col("id") % 7).alias("movie_id"),
                                        (F.col("id") % 5).cast("double").alias("rating"))
    users = spark.range(500).select(F.col("id").alias("user_id"), (F.col("id") % 9).alias("occupation_id"))
    names = spark.range(9).select(F.col("id").alias("occupation_id"), F.col("id").cast("string").alias("occupation"))
    df = movies.occupation_rating_summary(ratings, users, names)
    df.collect()
    # ratings by user, users by user, sums by occupation, names, final order
    assert plans.executed(df)["ShuffleExchangeExec"] == 5


def _hot(spark, path, n=300_000):
    """Ratings of which one user gave a third."""
    i = F.col("id")
    hot = F.when(i % 3 == 0, F.lit(1)).otherwise(F.pmod(F.xxhash64("id"), F.lit(20_000)) + 2)
    (spark.range(0, n, 1, 16).select(hot.alias("user_id"), (i % 1000).alias("movie_id"),
                                     ((i % 10) / 2).alias("rating"), F.sha2(i.cast("string"), 256).alias("note"))
     .write.parquet(path))
    return spark.read.parquet(path)


@pytest.fixture
def small_partitions(big, conf):
    """Skew thresholds scaled down to the size of the fixtures."""
    conf(**{"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k"})


@pytest.mark.parametrize("dedupe", [False, True])
def test_hot_user_is_split_over_tasks(spark, small_partitions, tmp_path, dedupe):
    ratings = _hot(spark, str(tmp_path / "r"))
    users = spark.range(20_003).select(F.col("id").alias("user_id"), F.when(F.col("id") % 2 == 0, "M").otherwise("F").alias("gender"))
    titles = spark.range(1000).select(F.col("id").alias("movie_id"), F.col("id").cast("string").alias("title"))
    df = movies.movie_gender_long(titles, ratings, joins.unique_dim(users, "user_id") if dedupe else users)
    got = {(r.title, r.gender): r.avg_rating for r in df.collect()}
    assert plans.executed(df)["skew"] >= 1
    plain = (ratings.join(F.broadcast(users), "user_id").groupBy("movie_id", "gender").agg(F.avg("rating").alias("a")))
    assert got == {(str(r.movie_id), r.gender): r.a for r in plain.collect()}


@pytest.mark.parametrize("distinct", [False, True])
def test_hot_word_is_split_in_the_exclusion_join(spark, small_partitions, tmp_path, distinct):
    words = _hot(spark, str(tmp_path / "w")).withColumn("word", F.concat(F.lit("w"), F.col("user_id").cast("string")))
    stop = spark.range(100).select(F.concat(F.lit("w"), (F.col("id") + 2).cast("string")).alias("w"))
    left = joins.exclude_terms(words, "word", stop.distinct() if distinct else stop)
    counted = left.groupBy("movie_id").agg(F.count("note").alias("n"))
    total = sum(r.n for r in counted.collect())
    assert total == words.where("user_id = 1 or user_id >= 102").count()
    assert plans.executed(counted)["skew"] >= 1


def test_hot_order_is_split_in_the_sales_join(spark, small_partitions, tmp_path):
    items = _hot(spark, str(tmp_path / "i")).select(
        F.col("user_id").alias("order_id"), F.concat("movie_id", "note").alias("product_id"))
    reviews = spark.range(40_000).select((F.col("id") % 20_003).alias("order_id"), F.lit("4").alias("score"))
    products = spark.range(1).select(F.lit("x").alias("product_id"), F.lit("c").alias("category"))
    for fan_out in (True, False):
        df = commerce.product_sales_and_rating(items, products, reviews, fan_out)
        sold = df.agg(F.sum("total_sold").alias("n"))
        counted = sold.collect()[0].n
        assert plans.executed(sold)["skew"] >= 1
        weight = F.size(F.filter(F.array(F.lit(0), F.lit(20_003)), lambda o: F.col("order_id") + o < 40_000)) if fan_out else F.lit(1)
        assert counted == items.agg(F.sum(weight)).first()[0]


def test_hot_word_is_split_in_tfidf(spark, small_partitions, tmp_path):
    words = _hot(spark, str(tmp_path / "w")).select(
        F.col("note").alias("doc"), F.concat(F.lit("w"), F.col("user_id").cast("string")).alias("word"))
    scored = terms.tfidf(words, ["doc"])
    summed = scored.groupBy(F.substring("doc", 1, 1)).agg(F.sum("tf").alias("tf"), F.count("tfidf").alias("n"))
    assert {(r.tf, r.n) for r in summed.collect()} == {
        (float(n), n) for n in [r["count"] for r in words.groupBy(F.substring("doc", 1, 1)).count().collect()]}
    assert plans.executed(summed)["skew"] >= 1


def test_hot_value_is_split_when_ranks_are_attached(spark, small_partitions, tmp_path):
    rows = _hot(spark, str(tmp_path / "r"))
    ranked = ranking.global_rank(rows, "user_id", "rk", buckets=16)
    seen = ranked.groupBy("rk").agg(F.count("note").alias("n"), F.min("user_id").alias("v"))
    got = sorted((r.rk, r.n, r.v) for r in seen.collect())
    assert plans.executed(seen)["skew"] >= 1
    above, want = 0, []
    for r in rows.groupBy("user_id").count().orderBy(F.desc("user_id")).collect():
        want.append((above + 1, r["count"], r.user_id))
        above += r["count"]
    assert got == want


def test_hot_key_leaves_each_task_as_one_row(spark, big):
    """A mean by a key that holds all rows shuffles one partial row per map task."""
    df = aggregates.mean_count(spark.range(0, 100_000, 1, 8).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("v")), ["k"], "v")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        nested = {"AdaptiveSparkPlanExec": "executedPlan"}.get(name) or ("plan" if name.endswith("QueryStageExec") else None)
        if nested:
            return walk(getattr(node, nested)())
        it = node.children().iterator()
        while it.hasNext():
            walk(it.next())

    walk(plan)
    assert found == [8]


def test_hot_order_is_not_multiplied(spark):
    """3,000 items and 3,000 reviews of one order are nine million pairs, counted but not built."""
    items = spark.range(3000).select(F.lit(1).alias("order_id"), (F.col("id") % 10).alias("product_id"))
    reviews = spark.range(3000).select(F.lit(1).alias("order_id"), (F.col("id") % 5 + 1).cast("string").alias("score"))
    products = spark.range(10).select(F.col("id").alias("product_id"), F.lit("c").alias("category"))
    df = commerce.product_sales_and_rating(items, products, reviews)
    assert [(r.total_sold, r.avg_rating) for r in df.collect()] == [(900_000, 3.0)] * 10


@pytest.mark.parametrize("listed", [1, 5000])
def test_a_listed_word_moves_no_text(spark, listed):
    words = spark.range(1000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("word"))
    left = joins.exclude_terms(words, "word", [f"w{i}" for i in range(listed)])
    assert left.count() == max(0, 1000 - listed)
    left.collect()
    seen = plans.executed(left)
    assert seen["BroadcastHashJoinExec"] == 1 and seen["ShuffleExchangeExec"] == 0


def test_clean_tokens_have_no_exchange(spark):
    df, seen = ran(spark, "clean_review_tokens")
    assert seen["ShuffleExchangeExec"] == 0
