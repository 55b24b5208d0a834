"""Text files in, report lines out."""

from pyspark.sql import functions as F

from sparktally.functions import formatting as fmt
from sparktally.plans import movies as m, reviews as r
from sparktally.sources import readers, sinks

FILES = {
    "movies.txt": ["1, Heat (1995), Action|Crime", "2, Good, the Bad (1966), Western", "3, Unrated (2000), Drama"],
    "ratings_1.txt": ["u1, 1, 4.0, 1577836800", "u2, 1, 3.5, 1577836800", "", "u3, 1, five, 1577836800",
                      "u1, 1, 5.0, 1609459200", "u2, 1, 4.0, 1609459200"],
    "ratings_2.txt": ["u2, 1, 2.5, 1609459200", "u1, 2, 4.5, 1609459200", "u9, 2, 1.0, 1609459200"],
    "users.txt": ["u1, M, 18, o1, 10000", "u2, F, 36, o2, 20000", "u3, M, 51, o1, 30000"],
}


def lines(spark, tmp_path, name, df, line):
    path = str(tmp_path / name)
    sinks.write_lines(sinks.render_lines(df, line), path, mode="overwrite", single_file=True)
    return [x.value for x in spark.read.text(path).collect()]


def test_movie_reports(spark, tmp_path):
    paths = {}
    for name, content in FILES.items():
        (tmp_path / name).write_bytes("\r\n".join(content).encode())
        paths[name] = str(tmp_path / name)
    films = readers.read_movies(spark, paths["movies.txt"])
    ratings = readers.read_ratings(spark, [paths["ratings_1.txt"], paths["ratings_2.txt"]], min_fields=4)
    users = readers.read_users(spark, paths["users.txt"])
    c = F.col

    summary = m.movie_rating_summary(films, ratings).orderBy("title")
    assert lines(spark, tmp_path, "summary", summary, fmt.summary_line(c("title"), c("avg_rating"), c("n_ratings"))) == [
        "Good, the Bad (1966) AverageRating: 2.75 (TotalRatings: 2)", "Heat (1995) AverageRating: 3.80 (TotalRatings: 5)"]
    best = m.top_rated_movie(films, ratings)
    assert lines(spark, tmp_path, "best", best, fmt.best_line(c("title"), c("avg_rating"), 5)) == [
        "Heat (1995) is the highest rated movie with an average rating of 3.80 among movies with at least 5 ratings."]
    genres = m.genre_rating_summary(films, ratings, precision="float")
    assert lines(spark, tmp_path, "genres", genres, fmt.genre_line(c("genre"), c("avg_rating"), c("n_ratings"))) == [
        "Action\tAvg: 3.80, Count: 5", "Crime\tAvg: 3.80, Count: 5", "Western\tAvg: 2.75, Count: 2"]
    gender = m.movie_gender_pivot(films, ratings, users).orderBy("title")
    assert lines(spark, tmp_path, "gender", gender, fmt.gender_line(c("title"), c("male_avg"), c("female_avg"))) == [
        "Good, the Bad (1966)\tMale: 4.50, Female: 0.00", "Heat (1995)\tMale: 4.50, Female: 3.33"]
    ages = m.movie_age_pivot(films, ratings, users).orderBy("title")
    bands = {label: c(name) for label, name in m.age_columns().items()}
    assert lines(spark, tmp_path, "ages", ages, fmt.bands_line(c("title"), bands)) == [
        "Good, the Bad (1966)\t0-18: 4.50   18-35: NA   35-50: NA   50+: NA   ",
        "Heat (1995)\t0-18: 4.50   18-35: NA   35-50: 3.33   50+: NA   "]
    years = m.yearly_rating_summary(ratings)
    assert lines(spark, tmp_path, "years", years, fmt.comma_line(c("year"), fmt.fixed(c("avg_rating")), c("n_ratings"))) == [
        "2020,3.75,2", "2021,3.40,5"]


def test_review_outputs(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text(
        "id;review;category;aspect;sentiment\n1;Phòng đẹp, phòng sạch;ROOM;A;positive\n2;phòng ồn;ROOM;B;negative\n"
        "3;giá hợp lý.;PRICE;A;positive\n")
    (tmp_path / "stop.txt").write_text("rất\nhợp\ntại sao\n")
    reviews = readers.read_reviews(spark, str(tmp_path / "reviews.csv"))
    stop = readers.read_wordlist(spark, str(tmp_path / "stop.txt"))
    sinks.write_table(r.clean_review_tokens(reviews, stop).where("review_id = 3"), str(tmp_path / "tokens"))
    assert [x.value for x in spark.read.text(str(tmp_path / "tokens")).collect()] == ["3\tgiá", "3\tlý."]
    top = r.top_words_by_category_sentiment(reviews, stop, k=2)
    sinks.write_split(top, "sentiment", str(tmp_path / "top"))
    positive = spark.read.parquet(str(tmp_path / "top" / "sentiment=positive"))
    got = {x.category: [tuple(w) for w in x.top_words] for x in positive.collect()}
    assert got == {"ROOM": [("phòng", 2), ("sạch", 1)], "PRICE": [("giá", 1), ("lý.", 1)]}
    counts = sinks.render_lines(r.reviews_by_category(reviews).orderBy("category"), fmt.comma_line(F.col("category"), F.col("n")))
    assert [x.value for x in counts.collect()] == ["PRICE,1", "ROOM,2", "category,0"]
