import pytest
from pyspark.sql import functions as F

from sparktally.functions import formatting, parsing
from sparktally.functions.text import token_array


def test_safe_int(spark):
    cases = [(None, None), ("", None), ("abc", None), ("4.7", 4), ("0", 0), (" 5 ", 5), ("-3", -3),
             ("+2", 2), ("NaN", None), ("1e3", 1000), ("1e2", 100), (".5", 0), ("-.5", 0),
             ("99999999999", None), ("1e400", None), ("4.", 4), ("7x", None), (".", None), ("Infinity", None)]
    df = spark.createDataFrame(cases, "text string, want int")
    assert [(r.text, r.got) for r in df.select("text", parsing.safe_int(F.col("text")).alias("got")).collect()] == cases


def test_safe_double(spark):
    df = spark.createDataFrame([(" 4.5",), ("x",), ("",), (None,)], "text string")
    assert [r[0] for r in df.select(parsing.safe_double(F.col("text"))).collect()] == [4.5, None, None, None]


@pytest.mark.parametrize("scheme,want", [
    (parsing.AGE_BANDS_WIDE, {17: "0-18", 18: "0-18", 19: "18-35", 35: "18-35", 36: "35-50", 50: "35-50", 51: "50+"}),
    (parsing.AGE_BANDS_FINE, {17: "Under18", 18: "18-25", 25: "18-25", 26: "26-35", 35: "26-35", 36: "36-45",
                              45: "36-45", 46: "46-50", 50: "46-50", 51: "50+"}),
])
def test_bands(spark, scheme, want):
    df = spark.createDataFrame([(a,) for a in want], "age int")
    got = {r[0]: r[1] for r in df.select("age", parsing.band(F.col("age"), scheme)).collect()}
    assert got == want
    assert parsing.band_labels(scheme)[-1] == "50+"


def test_movie_dialects(spark):
    df = spark.createDataFrame(
        [("1, Toy Story (1995), Animation|Comedy",), ("2,Good, the Bad, Western\r",), ("3",), ("4, Alone",), ("",)],
        "line string")

    def parse(dialect, trim=True):
        return [tuple(r) for r in df.select(*parsing.movie_fields(F.col("line"), dialect, trim)).collect()]

    none = (None, None, None)
    assert parse("first_comma") == [
        ("1", "Toy Story (1995), Animation|Comedy", None), ("2", "Good, the Bad, Western", None), none,
        ("4", "Alone", None), none]
    assert parse("three_way") == [
        ("1", "Toy Story (1995)", "Animation|Comedy"), ("2", "Good", "the Bad, Western"), none, none, none]
    assert parse("last_comma") == [
        ("1", "Toy Story (1995)", "Animation|Comedy"), ("2", "Good, the Bad", "Western"), none, none, none]
    assert parse("last_comma", trim=False)[0][1] == " Toy Story (1995)"
    with pytest.raises(ValueError):
        parse("other")


def test_epoch_year_depends_on_the_named_zone_only(spark, conf):
    df = spark.createDataFrame([(1577836800,), (1577836799,)], "ts bigint")
    for zone in ("UTC", "America/New_York"):
        conf(**{"spark.sql.session.timeZone": zone})
        got = df.select(parsing.epoch_year(F.col("ts")), parsing.epoch_year(F.col("ts"), "America/New_York"),
                        parsing.epoch_year(F.col("ts"), "Asia/Tokyo")).collect()
        assert [tuple(r) for r in got] == [(2020, 2019, 2020), (2019, 2019, 2020)]


def test_split_multi(spark):
    df = spark.createDataFrame([("a|b",), ("a|",), ("",), (None,)], "g string")
    assert [r[0] for r in df.select(parsing.split_multi(F.col("g"))).collect()] == [["a", "b"], ["a"], [], None]


def test_scaled_sums_do_not_depend_on_order(spark):
    df = spark.range(1000).select((F.col("id") * 0.1).alias("x"))
    units = df.agg(F.sum(parsing.scaled(F.col("x")))).first()[0]
    assert units == sum(round(i * 10) for i in range(1000))


def test_tokens(spark):
    text = 'Giá "hợp lý." (rẻ),*ĐẸP*\tgood/bad\nx'
    got = [w for w in spark.createDataFrame([(text,)], "t string").select(token_array(F.col("t"))).first()[0] if w]
    assert got == ["giá", "hợp", "lý.", "rẻ", "đẹp", "good/bad", "x"]
    plain = spark.createDataFrame([("a\tb c",)], "t string").select(token_array(F.col("t"), ' ",()*')).first()[0]
    assert plain == ["a\tb", "c"]


def test_rendering(spark):
    df = spark.createDataFrame([("T", 4.25, 2, None)], "title string, m double, n bigint, x double")
    t, m, n, x = (F.col(c) for c in df.columns)
    got = df.select(
        formatting.summary_line(t, m, n), formatting.genre_line(t, m, n), formatting.gender_line(t, m, F.lit(0.0)),
        formatting.bands_line(t, {"0-18": x, "18-35": m}), formatting.best_line(t, m, 5),
        formatting.comma_line(t, formatting.fixed(m), n)).first()
    assert list(got) == [
        "T AverageRating: 4.25 (TotalRatings: 2)", "T\tAvg: 4.25, Count: 2", "T\tMale: 4.25, Female: 0.00",
        "T\t0-18: NA   18-35: 4.25   ",
        "T is the highest rated movie with an average rating of 4.25 among movies with at least 5 ratings.",
        "T,4.25,2"]


def test_iso_utc_in_any_session_zone(spark, conf):
    df = spark.createDataFrame([(1767225600000000,), (1767225600123456,), (-1,), (1710037800000000,)], "us bigint")
    for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
        conf(**{"spark.sql.session.timeZone": zone})
        got = [r[0] for r in df.select(formatting.iso_utc(F.timestamp_micros("us"))).collect()]
        assert got == ["2026-01-01T00:00:00+00:00", "2026-01-01T00:00:00.123456+00:00", "1969-12-31T23:59:59.999999+00:00",
                       "2024-03-10T02:30:00+00:00"]
