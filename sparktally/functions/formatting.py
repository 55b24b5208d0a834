"""Text rendering of typed results."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def fixed(value: Column, digits: int = 2, missing: str = "NA") -> Column:
    """Number with fixed decimals, a half rounded up; null becomes `missing`."""
    return F.when(value.isNull(), F.lit(missing)).otherwise(F.format_string(f"%.{digits}f", value))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with a +00:00 offset, whatever the session zone is.

    The fraction is written with six digits and left out when it is zero.
    """
    micros = F.unix_micros(ts.cast("timestamp"))
    whole, fraction = F.floor(micros / 1_000_000), F.pmod(micros, F.lit(1_000_000))
    # A wall clock without a zone: no clock change of the session zone comes in.
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=whole)
    part = F.when(fraction == 0, "").otherwise(F.concat(F.lit("."), F.lpad(fraction.cast("string"), 6, "0")))
    return F.concat(F.replace(utc.cast("string"), F.lit(" "), F.lit("T")), part, F.lit("+00:00"))


# The sentences below are fixed values of the published outputs.

def summary_line(title: Column, mean: Column, n: Column) -> Column:
    """'<title> AverageRating: 4.25 (TotalRatings: 2)'"""
    return F.concat(title, F.lit(" AverageRating: "), fixed(mean),
                    F.lit(" (TotalRatings: "), n.cast("string"), F.lit(")"))


def best_line(title: Column, mean: Column, min_count: int) -> Column:
    return F.concat(title, F.lit(" is the highest rated movie with an average rating of "),
                    fixed(mean), F.lit(f" among movies with at least {min_count} ratings."))


def genre_line(genre: Column, mean: Column, n: Column) -> Column:
    """'<genre>\\tAvg: 3.81, Count: 76'"""
    return F.concat(genre, F.lit("\tAvg: "), fixed(mean), F.lit(", Count: "), n.cast("string"))


def gender_line(title: Column, male: Column, female: Column) -> Column:
    """'<title>\\tMale: 3.00, Female: 4.50'"""
    return F.concat(title, F.lit("\tMale: "), fixed(male), F.lit(", Female: "), fixed(female))


def bands_line(title: Column, bands: dict[str, Column]) -> Column:
    """'<title>\\t0-18: NA   18-35: 3.75   ...' with three blanks after every band."""
    parts = [title, F.lit("\t")]
    for label, mean in bands.items():
        parts += [F.lit(f"{label}: "), fixed(mean), F.lit("   ")]
    return F.concat(*parts)


def comma_line(*columns: Column) -> Column:
    """Values separated by commas, doubles already rendered by `fixed`."""
    return F.concat_ws(",", *columns)
