"""Movie rating analyses.

Tables: movies(movie_id, title, genres), ratings(user_id, movie_id, rating, ts),
users(user_id, gender, age, occupation_id, ...), occupations(occupation_id, occupation).
Movies, users and occupations are unique on their id (see `unique_dim`).

Ratings are reduced to (sum, count) per key before any dimension is joined,
so a hot movie or user crosses the network as partial rows.  Where a user
attribute is needed next to the movie, the ratings themselves are joined to
the users; Spark broadcasts the users if they are small and otherwise splits
the partitions of hot users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparktally.functions.parsing import (
    AGE_BANDS_FINE, AGE_BANDS_WIDE, band, band_labels, epoch_year, split_multi)
from sparktally.operators.aggregates import (
    finish_mean, mean_count, merge_partials, partial_mean, pivot_partials)
from sparktally.operators.joins import lookup
from sparktally.operators.ranking import top_k


def movie_rating_summary(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """title, avg_rating, n_ratings per movie id; movies without ratings are absent."""
    means = mean_count(ratings, ["movie_id"], "rating")
    return (lookup(means, movies.select("movie_id", "title"), "movie_id")
            .select("title", "avg_rating", "n_ratings"))


def top_rated_movies(movies: DataFrame, ratings: DataFrame, min_count: int = 5,
                     k: int | None = 10) -> DataFrame:
    """avg_rating, title, n_ratings of the best movies with enough ratings."""
    supported = mean_count(ratings, ["movie_id"], "rating").where(F.col("n_ratings") >= min_count)
    named = lookup(supported, movies.select("movie_id", "title"), "movie_id")
    order = [F.desc("avg_rating"), F.asc("title"), F.asc("movie_id")]
    return top_k(named, order, k).select("avg_rating", "title", "n_ratings")


def top_rated_movie(movies: DataFrame, ratings: DataFrame, min_count: int = 5) -> DataFrame:
    """title, avg_rating, n_ratings of the best movie; no row when none has enough ratings."""
    return (top_rated_movies(movies, ratings, min_count, 1)
            .select("title", "avg_rating", "n_ratings"))


def genre_rating_summary(movies: DataFrame, ratings: DataFrame, precision: str = "double",
                         sort: str = "genre") -> DataFrame:
    """genre, avg_rating, n_ratings, sorted by genre or by mean descending.

    A rating counts once for every genre of its movie.  Ratings are reduced
    per movie first, so the genres are flattened over movies, not ratings.
    """
    per_movie = partial_mean(ratings, ["movie_id"], "rating")
    genres = movies.select("movie_id", split_multi(F.col("genres")).alias("_genres"))
    flat = lookup(per_movie, genres, "movie_id").select(
        F.explode("_genres").alias("genre"), "_total", "_n")
    means = finish_mean(merge_partials(flat, ["genre"]), precision=precision)
    order = {"genre": [F.asc("genre")], "avg": [F.desc("avg_rating"), F.asc("genre")]}[sort]
    return means.orderBy(*order)


def _by_user_attribute(ratings: DataFrame, users: DataFrame, attribute: str) -> DataFrame:
    """(movie_id, attribute, sum, count); ratings of unknown users are dropped."""
    pairs = ratings.where(F.col("rating").isNotNull()).select("user_id", "movie_id", "rating")
    joined = lookup(pairs, users.select("user_id", attribute), "user_id", hot_keys=True)
    return partial_mean(joined, ["movie_id", attribute], "rating")


def _titled(parts: DataFrame, movies: DataFrame, fallback_to_id: bool = False) -> DataFrame:
    titles = movies.select("movie_id", "title")
    if not fallback_to_id:
        return lookup(parts, titles, "movie_id")
    named = lookup(parts, titles, "movie_id", "left")
    return named.withColumn(
        "title", F.coalesce(F.nullif("title", F.lit("")), F.col("movie_id").cast("string")))


def movie_gender_pivot(movies: DataFrame, ratings: DataFrame, users: DataFrame,
                       key: str = "title", precision: str = "float") -> DataFrame:
    """title, male_avg, female_avg; 0.0 where a title has no rating of that gender.

    Gender is compared without case; other genders count for neither mean.
    `key='title'` merges movies of equal title, `key='movie_id'` keeps them apart.
    """
    parts = _titled(_by_user_attribute(ratings, users, "gender"), movies.where(F.col("title") != ""))
    keys = ["title"] if key == "title" else ["movie_id", "title"]
    outputs = {"M": "male_avg", "F": "female_avg"}
    return pivot_partials(parts, keys, F.upper(F.trim("gender")), outputs,
                          missing=0.0, precision=precision)


def movie_gender_long(movies: DataFrame, ratings: DataFrame, users: DataFrame) -> DataFrame:
    """title, gender, avg_rating per movie id and gender; no row without ratings."""
    means = finish_mean(_by_user_attribute(ratings, users, "gender"), n=None)
    return _titled(means, movies).select("title", "gender", "avg_rating")


def _with_band(users: DataFrame, scheme) -> DataFrame:
    known = users.where(F.col("age").isNotNull())
    return known.withColumn("band", band(F.col("age"), scheme))


def age_columns(scheme=AGE_BANDS_WIDE) -> dict[str, str]:
    """Band label -> column name of `movie_age_pivot`."""
    names = {}
    for label in band_labels(scheme):
        names[label] = "age_" + label.lower().replace("-", "_").replace("+", "_plus")
    return names


def movie_age_pivot(movies: DataFrame, ratings: DataFrame, users: DataFrame,
                    scheme=AGE_BANDS_WIDE, key: str = "title",
                    precision: str = "float") -> DataFrame:
    """title and one mean per age band, null where a band has no rating.

    A movie without a title is listed under its id.
    """
    parts = _titled(_by_user_attribute(ratings, _with_band(users, scheme), "band"),
                    movies, fallback_to_id=True)
    keys = ["title"] if key == "title" else ["movie_id", "title"]
    return pivot_partials(parts, keys, F.col("band"), age_columns(scheme), precision=precision)


def movie_age_long(movies: DataFrame, ratings: DataFrame, users: DataFrame,
                   scheme=AGE_BANDS_FINE) -> DataFrame:
    """title, band, avg_rating per movie id and age band; no row without ratings."""
    means = finish_mean(_by_user_attribute(ratings, _with_band(users, scheme), "band"), n=None)
    return _titled(means, movies).select("title", "band", "avg_rating")


def occupation_rating_summary(ratings: DataFrame, users: DataFrame,
                              occupations: DataFrame) -> DataFrame:
    """occupation, avg_rating, n_ratings, best mean first.

    Reduced per user before the join to the users, which then needs no
    further shuffle of the ratings.
    """
    per_user = partial_mean(ratings, ["user_id"], "rating")
    coded = lookup(per_user, users.select("user_id", "occupation_id"), "user_id")
    means = finish_mean(merge_partials(coded, ["occupation_id"]))
    return (lookup(means, occupations, "occupation_id")
            .select("occupation", "avg_rating", "n_ratings")
            .orderBy(F.desc("avg_rating"), F.asc("occupation")))


def yearly_rating_summary(ratings: DataFrame, time_zone: str = "UTC") -> DataFrame:
    """year, avg_rating, n_ratings in year order."""
    dated = ratings.select(epoch_year(F.col("ts"), time_zone).alias("year"), "rating")
    return mean_count(dated, ["year"], "rating").orderBy("year")
