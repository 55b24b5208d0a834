"""Tolerant casts, title/genre splitting and age bands."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# (upper limit inclusive, label) in ascending order, then the open label.
# Fixed values of the two published banding schemes.
AGE_BANDS_WIDE = ([(18, "0-18"), (35, "18-35"), (50, "35-50")], "50+")
AGE_BANDS_FINE = (
    [(17, "Under18"), (25, "18-25"), (35, "26-35"), (45, "36-45"), (50, "46-50")],
    "50+",
)


def band(value: Column, scheme: tuple[list[tuple[int, str]], str]) -> Column:
    """Label of the first band whose upper limit holds the value; null stays null."""
    limits, rest = scheme
    label = F.when(value.isNull(), F.lit(None).cast("string"))
    for upper, name in limits:
        label = label.when(value <= upper, F.lit(name))
    return label.otherwise(F.lit(rest))


def band_labels(scheme: tuple[list[tuple[int, str]], str]) -> list[str]:
    limits, rest = scheme
    return [name for _, name in limits] + [rest]


def safe_double(value: Column) -> Column:
    """Number or null; never raises under ANSI mode."""
    return F.trim(value).try_cast("double")


def safe_int(value: Column) -> Column:
    """Whole part of a decimal text or number, null for anything else.

    '4.7' gives 4, ' 5 ' 5, '1e2' 100 and '.5' 0; '', 'abc', 'NaN' and out-of-range give null.
    """
    # The pattern keeps junk away from the cast, which is slow to refuse it.
    pattern = F.lit(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    return F.regexp_substr(F.trim(value.cast("string")), pattern).try_cast("double").try_cast("int")


def split_multi(value: Column) -> Column:
    """'a|b|c' as an array; empty parts are dropped."""
    return F.filter(F.split(value, r"\|"), lambda part: part != "")


def movie_fields(line: Column, dialect: str, trim: bool = True) -> tuple[Column, Column, Column]:
    """(movie_id, title, genres) of one text line, null when the line is too short.

    first_comma  title is everything after the first comma, there are no genres
    three_way    at most three parts; a comma inside the title spoils the genres
    last_comma   id before the first comma, genres after the last one
    """
    text = F.regexp_replace(line, r"\r$", "")
    tidy = F.trim if trim else (lambda c: c)
    if dialect == "first_comma":
        pattern = r"(?s)^([^,]*),(.*)$"
        ok = text.rlike(pattern)
        movie_id = F.regexp_extract(text, pattern, 1)
        title = F.regexp_extract(text, pattern, 2)
        genres = F.lit(None).cast("string")
    elif dialect == "three_way":
        parts = F.split(text, r",\s*", 3)
        ok = F.size(parts) >= 3
        movie_id, title, genres = (F.get(parts, F.lit(i)) for i in range(3))
    elif dialect == "last_comma":
        pattern = r"(?s)^([^,]*),(.*),([^,]*)$"
        ok = text.rlike(pattern)
        movie_id, title, genres = (F.regexp_extract(text, pattern, i) for i in (1, 2, 3))
    else:
        raise ValueError(f"unknown dialect {dialect!r}")
    keep = lambda c: F.when(ok, c)
    return keep(F.trim(movie_id)), keep(tidy(title)), keep(F.trim(genres))


def epoch_year(seconds: Column, time_zone: str = "UTC") -> Column:
    """Calendar year of epoch seconds in the named zone, whatever the session zone is."""
    wall = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    if time_zone != "UTC":
        wall = F.convert_timezone(F.lit("UTC"), F.lit(time_zone), wall)
    return F.year(wall)


def in_year(ts: Column, year: int) -> Column:
    """`year(ts) = year` as a range, which a parquet scan can push down."""
    return (ts >= F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz")) & (
        ts < F.lit(f"{year + 1}-01-01 00:00:00").cast("timestamp_ntz"))


def scaled(value: Column, digits: int = 2) -> Column:
    """Amount as a whole number of its smallest unit.

    Integer sums do not depend on the order of the rows, so ranks and ties
    come out the same on every run, and they stay in generated code where a
    wide decimal would not.
    """
    return F.rint(value * F.lit(float(10 ** digits))).cast("bigint")


def unscaled(units: Column, digits: int = 2) -> Column:
    return units.cast("double") / F.lit(float(10 ** digits))
