import pytest
from conftest import rows

from sparktally.operators.joins import unique_dim
from sparktally.plans import movies as m
from sparktally.functions.parsing import AGE_BANDS_FINE


@pytest.fixture(scope="module")
def data(spark):
    movies = spark.createDataFrame(
        [("1", "Alpha", "Drama|Action"), ("2", "Beta", "Drama"), ("3", "Alpha", "Comedy"), ("4", "Rare", None)],
        "movie_id string, title string, genres string")
    ratings = spark.createDataFrame(
        [("u1", "1", 4.0, 1577836800), ("u2", "1", 3.0, 1577836800), ("u3", "1", 5.0, 1577836799),
         ("u1", "2", 2.5, 1609459200), ("u4", "2", 3.5, 1609459200), ("u2", "3", 1.0, 1609459200),
         ("u9", "2", 5.0, 1609459200), ("u1", "99", 4.5, 1609459200), ("u5", "1", None, 1609459200)],
        "user_id string, movie_id string, rating double, ts bigint")
    users = spark.createDataFrame(
        [("u1", "M", 18, "o1"), ("u2", "f", 19, "o2"), ("u3", "F", 51, "o1"), ("u4", "X", 36, "o3"), ("u5", "M", None, "o1")],
        "user_id string, gender string, age int, occupation_id string")
    occupations = spark.createDataFrame(
        [("o1", "Programmer"), ("o2", "Doctor"), ("o4", "Researcher")], "occupation_id string, occupation string")
    return movies, ratings, users, occupations


def test_summary(data):
    movies, ratings, *_ = data
    assert rows(m.movie_rating_summary(movies, ratings)) == [
        ("Alpha", 1.0, 1), ("Alpha", 4.0, 3), ("Beta", 11.0 / 3, 3)]


def test_top_rated(data):
    movies, ratings, *_ = data
    assert rows(m.top_rated_movie(movies, ratings)) == []
    assert rows(m.top_rated_movie(movies, ratings, min_count=3)) == [("Alpha", 4.0, 3)]
    top = m.top_rated_movies(movies, ratings, min_count=1, k=2).collect()
    assert [tuple(r) for r in top] == [(4.0, "Alpha", 3), (11.0 / 3, "Beta", 3)]
    assert m.top_rated_movies(movies, ratings, min_count=1, k=None).count() == 3


def test_ties_go_to_the_first_title(spark):
    movies = spark.createDataFrame([("1", "B", ""), ("2", "A", "")], "movie_id string, title string, genres string")
    ratings = spark.createDataFrame([(i, 4.0) for i in ("1", "2") for _ in range(5)], "movie_id string, rating double")
    assert rows(m.top_rated_movie(movies, ratings)) == [("A", 4.0, 5)]


def test_genres(data):
    movies, ratings, *_ = data
    by_name = [tuple(r) for r in m.genre_rating_summary(movies, ratings).collect()]
    assert by_name == [("Action", 4.0, 3), ("Comedy", 1.0, 1), ("Drama", 23.0 / 6, 6)]
    by_mean = [r.genre for r in m.genre_rating_summary(movies, ratings, sort="avg").collect()]
    assert by_mean == ["Action", "Drama", "Comedy"]


def test_gender_pivot(data):
    movies, ratings, users, _ = data
    merged = rows(m.movie_gender_pivot(movies, ratings, users))
    assert merged == [("Alpha", 4.0, 3.0), ("Beta", 2.5, 0.0)]
    apart = rows(m.movie_gender_pivot(movies, ratings, users, key="movie_id"))
    assert apart == [("1", "Alpha", 4.0, 4.0), ("2", "Beta", 2.5, 0.0), ("3", "Alpha", 0.0, 1.0)]


def test_gender_long(data):
    movies, ratings, users, _ = data
    assert rows(m.movie_gender_long(movies, ratings, users)) == [
        ("Alpha", "F", 5.0), ("Alpha", "M", 4.0), ("Alpha", "f", 1.0), ("Alpha", "f", 3.0),
        ("Beta", "M", 2.5), ("Beta", "X", 3.5)]


def test_age_pivot_names_unknown_movies_by_id(data):
    movies, ratings, users, _ = data
    got = m.movie_age_pivot(movies, ratings, users)
    assert got.columns == ["title", "age_0_18", "age_18_35", "age_35_50", "age_50_plus"]
    assert rows(got) == [("99", 4.5, None, None, None), ("Alpha", 4.0, 2.0, None, 5.0), ("Beta", 2.5, None, 3.5, None)]


def test_age_long(data):
    movies, ratings, users, _ = data
    assert rows(m.movie_age_long(movies, ratings, users, AGE_BANDS_FINE)) == [
        # the two raters of the first Alpha, 18 and 19 years old, share a band
        ("Alpha", "18-25", 1.0), ("Alpha", "18-25", 3.5), ("Alpha", "50+", 5.0),
        ("Beta", "18-25", 2.5), ("Beta", "36-45", 3.5)]


def test_occupations(data):
    _, ratings, users, occupations = data
    got = [tuple(r) for r in m.occupation_rating_summary(ratings, users, occupations).collect()]
    assert got == [("Programmer", 4.0, 4), ("Doctor", 2.0, 2)]


def test_years(data):
    _, ratings, *_ = data
    assert [tuple(r) for r in m.yearly_rating_summary(ratings).collect()] == [
        (2019, 5.0, 1), (2020, 3.5, 2), (2021, 3.3, 5)]
    assert [r.year for r in m.yearly_rating_summary(ratings, "America/New_York").collect()] == [2019, 2020]


def test_duplicate_movies_multiply_unless_deduped(data):
    movies, ratings, *_ = data
    doubled = movies.union(movies)
    assert m.movie_rating_summary(doubled, ratings).count() == 6
    assert m.movie_rating_summary(unique_dim(doubled, "movie_id"), ratings).count() == 3


def test_counts_add_up(data):
    movies, ratings, *_ = data
    total = sum(r.n_ratings for r in m.movie_rating_summary(movies, ratings).collect())
    assert total == 7  # nine, less one without a rating and one without a movie
