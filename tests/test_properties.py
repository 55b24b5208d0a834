"""Facts that hold for any input, on generated tables."""

from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window as W, functions as F

from sparktally.functions.parsing import AGE_BANDS_FINE, AGE_BANDS_WIDE, band
from sparktally.operators import aggregates, ranking, terms

few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.sampled_from(["a", "a", "a", "b", "c", None])
halves = st.integers(1, 10).map(lambda n: n / 2)


@few
@given(st.lists(st.tuples(keys, st.one_of(st.none(), halves)), min_size=1, max_size=60))
def test_means_lie_between_and_counts_add_up(spark, data):
    df = spark.createDataFrame(data, "k string, v double")
    got = aggregates.mean_count(df, ["k"], "v", "m", "n").collect()
    assert sum(r.n for r in got) == sum(v is not None for _, v in data)
    for r in got:
        values = [v for k, v in data if k == r.k and v is not None]
        assert min(values) <= r.m <= max(values) and r.m == sum(values) / len(values)


@few
@given(st.lists(st.integers(0, 130), min_size=1, max_size=60))
def test_every_age_has_one_band_in_order(spark, ages):
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    for scheme in (AGE_BANDS_WIDE, AGE_BANDS_FINE):
        order = {label: i for i, (_, label) in enumerate(scheme[0])} | {scheme[1]: len(scheme[0])}
        got = [order[r[0]] for r in df.orderBy("age").select(band(F.col("age"), scheme)).collect()]
        assert got == sorted(got)


@few
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), max_size=80), st.integers(1, 12))
def test_ranks(spark, values, buckets):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v bigint")
    want = df.withColumn("rk", F.rank().over(W.orderBy(F.col("v").desc_nulls_last())).cast("bigint"))
    assert rows(ranking.global_rank(df, "v", "rk", buckets=buckets)) == rows(want)


@few
@given(st.lists(st.tuples(keys, st.text('ab ",()*\t.', max_size=12)), min_size=1, max_size=30), st.integers(1, 3))
def test_words(spark, data, k):
    df = spark.createDataFrame(data, "g string, text string")
    words = terms.words_of(df, "text", ["g"], ["a"])
    found = [r.word for r in words.collect()]
    assert "a" not in found and all(found) and not any(set(w) & set(' ",()*\t') for w in found)
    counts = terms.term_frequency(words.withColumn("g", F.coalesce("g", F.lit("?"))), ["g"])
    assert sum(r.freq for r in counts.collect()) == len(found)
    top = ranking.top_k_per_group(counts, ["g"], [F.desc("freq"), F.asc("word")], k).drop("rk")
    assert set(rows(top)) <= set(rows(counts))
    for r in terms.tfidf(words, ["g"]).groupBy("g").agg(F.sum("tf").alias("s"), F.min("tfidf").alias("m")).collect():
        assert abs(r.s - 1) < 1e-9 and r.m >= 0
