"""Batch sinks.  mode='overwrite' replaces, mode='errorifexists' refuses."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from sparktally.session import discard, scratch_path


def render_lines(df: DataFrame, line: Column) -> DataFrame:
    """One text column from a typed result; the order of the rows is kept."""
    return df.select(line.alias("value"))


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists",
                single_file: bool = False) -> None:
    """Text files, one row per line.

    `single_file` runs the last stage in one task: only for results that were
    aggregated or limited to a small size.
    """
    (lines.coalesce(1) if single_file else lines).write.mode(mode).text(path)


def _text(field: T.StructField) -> Column:
    """A field as delimited text: null is empty, nested values are JSON."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    column = F.col(field.name)
    text = F.to_json(column) if isinstance(field.dataType, nested) else column.cast("string")
    return F.coalesce(text, F.lit(""))


def write_table(df: DataFrame, path: str, sep: str = "\t", mode: str = "errorifexists",
                header: bool = False) -> None:
    """Delimited text.

    Without a header, fields are joined as they are: quotes are data and
    nothing is escaped.  With one, fields holding the separator are quoted.
    """
    if header:
        flat = df.select(*[_text(f).alias(f.name) for f in df.schema.fields])
        flat.write.mode(mode).option("sep", sep).option("header", True).option(
            "emptyValue", "").csv(path)
    else:
        line = F.concat_ws(sep, *[_text(f) for f in df.schema.fields])
        df.select(line.alias("value")).write.mode(mode).text(path)


def write_split(df: DataFrame, column: str, path: str, mode: str = "errorifexists") -> None:
    """One folder per value of `column` from one pass over the input.

    No shuffle: every task writes to the folders its rows belong to.
    """
    df.write.mode(mode).partitionBy(column).parquet(path)


def write_outputs(shared: DataFrame, outputs: Sequence[Callable[[DataFrame], None]]) -> None:
    """Several outputs that share a prefix, which is computed once.

    The prefix is written to the shared scratch folder, read again by every
    output, and deleted at the end.
    """
    spark = shared.sparkSession
    path = scratch_path(spark, "shared")
    shared.write.parquet(path)
    try:
        for write in outputs:
            write(spark.read.parquet(path))
    finally:
        discard(spark, path)
