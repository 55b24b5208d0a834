"""Means between loads, tables by key, counts from footers, archived sources."""

import os

import plans
import pytest
from conftest import rows
from pyspark.sql import functions as F

from sparktally import schemas
from sparktally.operators.aggregates import mean_count
from sparktally.operators.means_store import MeansStore
from sparktally.plans import movies
from sparktally.sources import layout, readers
from sparktally.streaming import pipeline as p


def test_means_after_three_loads_and_a_repeated_one(spark, tmp_path):
    files = []
    for i in range(4):
        path = tmp_path / f"r{i}.txt"
        path.write_text("\n".join(f"u{j},m{j % 5},{(i + j) % 9 / 2},1" for j in range(i, 20 + i)))
        files.append(str(path))
    store = MeansStore(spark, str(tmp_path / "store"), ["movie_id"], "rating")
    seen = []

    def read(new):
        seen.append(list(new))
        return readers.read_ratings(spark, new)

    assert store.means().count() == 0
    for asked, new in ((files[:2], files[:2]), (files[1:3], files[2:3]), (files[:3], []), (files, files[3:])):
        assert store.load(asked, read) == new
    assert seen == [files[:2], files[2:3], files[3:]]
    assert rows(store.means()) == rows(mean_count(readers.read_ratings(spark, files), ["movie_id"], "rating"))


def test_a_load_that_dies_is_read_again(spark, tmp_path):
    path = tmp_path / "r.txt"
    path.write_text("u,m,4,1\nu,m,2,1")
    store = MeansStore(spark, str(tmp_path / "store"), ["movie_id"], "rating")

    def lost(new):
        return readers.read_ratings(spark, new).withColumn("rating", F.raise_error(F.lit("lost")).cast("double"))

    with pytest.raises(Exception, match="lost"):
        store.load([str(path)], lost)
    assert store.partials() is None
    assert store.load([str(path)], lambda new: readers.read_ratings(spark, new)) == [str(path)]
    assert rows(store.means()) == [("m", 3.0, 2)]


def test_ratings_by_user_are_not_shuffled(spark, big, tmp_path):
    ratings = spark.range(5000).selectExpr("id % 300 AS user_id", "id % 20 AS movie_id", "id % 10 / 2.0D AS rating")
    users = spark.range(300).selectExpr("id AS user_id", "if(id % 2 = 0, 'M', 'F') AS gender", "int(id % 60) AS age",
                                        "id % 7 AS occupation_id")
    names = spark.range(7).selectExpr("id AS occupation_id", "string(id) AS occupation")
    films = spark.range(20).selectExpr("id AS movie_id", "string(id) AS title")
    stored = layout.store_by_key(ratings, str(tmp_path / "ratings"), "user_id", 8)
    people = layout.store_by_key(users, str(tmp_path / "users"), "user_id", 8)
    for run in (lambda r, u: movies.movie_gender_long(films, r, u), lambda r, u: movies.movie_age_long(films, r, u),
                lambda r, u: movies.occupation_rating_summary(r, u, names)):
        got = run(stored, people)
        assert rows(got) == rows(run(ratings, users))
        shuffled = run(ratings, users)
        shuffled.collect()
        # The users may be dealt again to where their ratings lie.
        assert plans.executed(got)["ShuffleExchangeExec"] < plans.executed(shuffled)["ShuffleExchangeExec"]
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert _exchanges_over(plan, "rating#") == 0


def _exchanges_over(plan: str, column: str) -> int:
    """Exchanges by user between the joins and the scan that reads the column."""
    lines = [(len(line) - len(line.lstrip(" :+-*()0123456789")), line) for line in plan.split("\n")]
    found = 0
    for i, (depth, line) in enumerate(lines):
        if "Exchange hashpartitioning(user_id" in line:
            inside = []
            for d, below in lines[i + 1:]:
                if d <= depth:
                    break
                inside.append(below)
            found += any("FileScan" in x and column in x for x in inside)
    return found


def test_counts_come_from_the_footers(spark):
    df = readers.read_footers(spark, "/root/testdata/sf0.001/orders.parquet")
    report = readers.describe_schema({"orders": df}, counts=True)
    plain = readers.describe_schema({"orders": spark.read.parquet("/root/testdata/sf0.001/orders.parquet")}, counts=True)
    assert rows(report) == rows(plain)
    counted = df.agg(*[F.count(c) for c in df.columns])
    assert "PushedAggregation: [COUNT(o_orderkey)" in counted._jdf.queryExecution().executedPlan().toString()


def test_files_that_are_done_with_are_archived(spark, tmp_path):
    raw, store = tmp_path / "raw", str(tmp_path / "store")
    raw.mkdir()
    (tmp_path / "old").mkdir()
    for n in range(12):
        (raw / f"{n:03d}.txt").write_text(f'{{"frame_id": "f{n}"}}\n')
        stream = p.read_message_stream(spark, schemas.DETECTION_RECORD, path=str(raw), max_files=1, archive=str(tmp_path / "old"))
        p.store_detections(stream, store, str(tmp_path / "check"), available_now=True).awaitTermination()
        assert len(os.listdir(raw)) <= 3
    assert sorted(r.frame_id for r in readers.read_detections(spark, store).collect()) == sorted(f"f{n}" for n in range(12))
