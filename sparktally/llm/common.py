"""Helpers shared by the operators of this subpackage.

A table may hold extra columns of any name.  Operators therefore read the
few columns they need into a narrow table with names of their own, and carry
whole rows as one struct where rows have to travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparktally.session import ensure_checkpoint_dir

#: The white space of all word rules here: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"
TIE_BITS = 52


def settle(df: DataFrame) -> DataFrame:
    """`df` written once to the shared checkpoint folder and read from there.

    Cuts the lineage: a lost executor costs a read, not the work before it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def tie_hash(value: Column, salt: str = "") -> Column:
    """52 bits of MD5 of the value's text: a fixed random order that SQL can state too."""
    text = F.concat(F.lit(salt), F.coalesce(value.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, TIE_BITS // 4), 16, 10).cast("long")


def carried(docs: DataFrame) -> Column:
    """The whole row as one struct, so that its names cannot clash."""
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns])


def whole_hash(docs: DataFrame) -> Column:
    """A hash of all columns; nulls count, and nested values, maps included, go in as JSON."""
    nested = ("struct", "array", "map", "variant")
    columns = [(docs[f"`{f.name}`"], f.dataType.simpleString().startswith(nested)) for f in docs.schema]
    return F.xxhash64(*[F.to_json(F.struct(c.alias("c"))) if deep else c for c, deep in columns],
                      *[c.isNull() for c, _ in columns])


def positions(rows: DataFrame, group: list[str], cell: str, tie: str, last: list[str],
              salt_bits: int = 10) -> DataFrame:
    """Adds `position`, from 0, of each row in its group by (cell, tie, last).

    A prefix sum in three levels instead of one window per group: rows are
    counted per (group, cell, leading bits of `tie`), the counts are summed
    along the cells of a group and along the blocks of a cell, and rows are
    numbered inside their block only.  A group, or a cell, that holds a third
    of all rows is so spread over 2**salt_bits blocks.  `cell` is a
    whole number of bounded range and `tie` a hash below 2**52; both decide
    the order together with `last`, so runs agree.  Groups, cells and ties are not null.
    """
    block = F.shiftright(F.col(tie), TIE_BITS - salt_bits)
    rows = rows.withColumn("_block", block)
    keys = [*group, cell]
    blocks = rows.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    cells = blocks.groupBy(*keys).agg(F.sum("_n").alias("_n"))
    along = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(*keys, F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_cells_before"))
    inside = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.join(cells, keys).select(
        *keys, "_block",
        (F.col("_cells_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0))).alias("_before"))
    number = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(tie, *last))
    return (rows.join(blocks, [*keys, "_block"])
            .withColumn("position", F.col("_before") + number - 1)
            .drop("_block", "_before"))

