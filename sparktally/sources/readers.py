"""Batch sources.  Schemas are declared; inference is an option only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from sparktally import schemas
from sparktally.functions.parsing import movie_fields, safe_double, safe_int
from sparktally.operators.rejects import Rejects

Paths = str | Sequence[str]


def _paths(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _positional(spark: SparkSession, paths: Paths, schema: T.StructType) -> DataFrame:
    """Comma-separated fields without quoting; blanks around fields are dropped.

    Short rows get nulls, surplus fields are ignored, blank lines are skipped,
    and both line endings are accepted.  Several paths make one bag union.
    """
    return (spark.read.schema(schema)
            .option("sep", ",").option("quote", "")
            .option("ignoreLeadingWhiteSpace", True)
            .option("ignoreTrailingWhiteSpace", True)
            .csv(_paths(paths)))


def _rating_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """`parts`, the trimmed fields of each line that is not blank; separators decide their number."""
    line = F.regexp_replace("value", r"\r$", "")
    return (spark.read.text(_paths(paths)).where(F.trim(line) != "")
            .select(F.transform(F.split(line, ",", -1), lambda part: F.trim(part)).alias("parts")))


def read_ratings(spark: SparkSession, paths: Paths, min_fields: int = 3,
                 on_bad: str = "drop", rejects: Rejects | None = None) -> DataFrame:
    """user_id, movie_id, rating DOUBLE, ts BIGINT (epoch seconds).

    Lines with fewer than `min_fields` fields are dropped; an empty field is a
    field.  A rating that is no number, an empty one included, is dropped, kept
    as null, or fails the job (`on_bad` = drop, null, fail).  `rejects` counts, in the same
    pass, n_short lines and those with an n_bad_rating.
    """
    field = lambda i: F.get("parts", F.lit(i))
    lines = _rating_lines(spark, paths)
    if rejects is not None:
        lines = rejects.watch(lines, **_rating_faults(min_fields))
    lines = lines.where(F.size("parts") >= min_fields)
    if on_bad == "fail":
        bad = F.concat(F.lit("rating is not a number: "), F.coalesce(field(2), F.lit("")))
        rating = F.coalesce(safe_double(field(2)), F.raise_error(bad).cast("double"))
    elif on_bad in ("drop", "null"):
        rating = safe_double(field(2))
    else:
        raise ValueError(f"unknown on_bad {on_bad!r}")
    rows = lines.select(field(0).alias("user_id"), field(1).alias("movie_id"), rating.alias("rating"),
                        field(3).try_cast("bigint").alias("ts"))
    return rows.where(F.col("rating").isNotNull()) if on_bad == "drop" else rows


def _rating_faults(min_fields: int) -> dict[str, Column]:
    """Why a rating line is left out, one reason per line."""
    short = F.size("parts") < min_fields
    return {"n_short": short, "n_bad_rating": ~short & safe_double(F.get("parts", F.lit(2))).isNull()}


def rating_rejects(spark: SparkSession, paths: Paths, min_fields: int = 3) -> DataFrame:
    """One row: n_rows, n_short, n_bad_rating of the rating files, by a pass of its own."""
    return _rating_lines(spark, paths).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(fault).alias(name) for name, fault in _rating_faults(min_fields).items()])


def read_users(spark: SparkSession, paths: Paths) -> DataFrame:
    """user_id, gender, age INT (null when no number), occupation_id, zip."""
    raw = _positional(spark, paths, schemas.USER_FIELDS)
    return raw.where(F.col("gender").isNotNull()).withColumn("age", safe_int(F.col("age")))


def read_occupations(spark: SparkSession, paths: Paths) -> DataFrame:
    return (_positional(spark, paths, schemas.OCCUPATION_FIELDS)
            .where(F.col("occupation").isNotNull()))


def read_movies(spark: SparkSession, paths: Paths, dialect: str = "last_comma",
                trim: bool = True) -> DataFrame:
    """movie_id, title, genres (still joined by '|').

    `dialect` is first_comma, three_way, last_comma (see `movie_fields`) or
    csv, where quotes protect commas.
    """
    if dialect == "csv":
        return (spark.read.schema(schemas.MOVIE_FIELDS)
                .option("sep", ",").option("quote", '"').option("escape", '"')
                .csv(_paths(paths)))
    lines = spark.read.text(_paths(paths))
    movie_id, title, genres = movie_fields(F.col("value"), dialect, trim)
    return (lines.select(movie_id.alias("movie_id"), title.alias("title"), genres.alias("genres"))
            .where(F.col("movie_id").isNotNull()))


def read_delimited(spark: SparkSession, paths: Paths, schema: T.StructType,
                   sep: str = ";") -> DataFrame:
    """Header-less text with a declared schema; quote characters are data.

    A value that does not fit its type is null, a short row ends in nulls,
    surplus fields are dropped.
    """
    return (spark.read.schema(schema).option("sep", sep).option("quote", "")
            .option("mode", "PERMISSIVE").csv(_paths(paths)))


def read_reviews(spark: SparkSession, paths: Paths) -> DataFrame:
    return read_delimited(spark, paths, schemas.REVIEWS)


def read_wordlist(spark: SparkSession, paths: Paths, name: str = "word") -> DataFrame:
    """One distinct entry per line; inner blanks stay."""
    entry = F.trim(F.regexp_replace("value", r"\r$", ""))
    return (spark.read.text(_paths(paths)).select(entry.alias(name))
            .where(F.col(name) != "").distinct())


def read_table(spark: SparkSession, paths: Paths, sep: str = ";", header: bool = True,
               schema: T.StructType | None = None) -> DataFrame:
    """Delimited text with a header; types are inferred, at the price of one
    more pass over the files, only when no schema is given."""
    reader = spark.read.option("header", header).option("sep", sep)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(_paths(paths))


def read_commerce(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five commerce files by name, each read once, with our column names."""
    tables = {}
    for name, (file_name, columns) in schemas.COMMERCE_FILES.items():
        raw = read_table(spark, f"{folder.rstrip('/')}/{file_name}")
        present = {old: new for old, new in columns.items() if old in raw.columns}
        tables[name] = raw.select(*[F.col(old).alias(new) for old, new in present.items()])
    return tables


def describe_schema(tables: dict[str, DataFrame], counts: bool = False) -> DataFrame:
    """table_name, position, column_name, type of every column, from the schemas alone.

    With `counts` also n_values (non-null), from one scan of every table; of tables read by
    `read_footers` from the footers alone.
    """
    reports = []
    for table, df in tables.items():
        names = ["position", "column_name", "type"]
        rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
        if counts:
            counted = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
            entries = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)],
                                         F.col(f"`{row[1]}`").alias("n_values")) for row in rows])
            reports.append(counted.select(F.lit(table).alias("table_name"), F.inline(entries)))
        else:
            listed = df.sparkSession.createDataFrame(rows, "position int, column_name string, type string")
            reports.append(listed.select(F.lit(table).alias("table_name"), *names))
    report = reports[0]
    for other in reports[1:]:
        report = report.unionByName(other)
    return report


def read_footers(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table whose counts, least and largest values of columns Spark takes from the file footers.

    That is a feature of Spark's second reader and off by default; the settings hold in a session
    of its own, to which the frame belongs.  Frames of both sessions do not join.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path)


def read_frames(spark: SparkSession, folder: str, streaming: bool = False,
                max_files: int | None = None) -> DataFrame:
    """Image files of a folder: path, modificationTime, length, content.

    A stream takes at most `max_files` new files per batch, all waiting ones if not given.
    """
    if not streaming:
        return (spark.read.format("binaryFile").option("pathGlobFilter", "*.{jpg,jpeg,png}")
                .load(folder))
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.option("pathGlobFilter", "*.{jpg,jpeg,png}").load(folder)


def frame_paths(frames: DataFrame) -> DataFrame:
    """Sorted path listing, without reading the contents."""
    return frames.select("path").orderBy("path")


def read_detections(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The detection store as a table."""
    return spark.read.schema(schemas.DETECTION_RECORD).format(fmt).load(path)
