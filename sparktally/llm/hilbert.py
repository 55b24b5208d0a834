"""Sharding along a Hilbert curve through several metadata dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparktally.llm.common import carried, positions, settle, tie_hash, whole_hash


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often `body` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _turn(point: Column, axis: int, step: Column, dims: int) -> Column:
    """One step of the way back along the curve: flip or swap the bits below `step`."""
    low = step - 1
    first, here = F.element_at(point, 1), F.element_at(point, axis + 1)
    swap = first.bitwiseXOR(here).bitwiseAND(low)
    others = [F.element_at(point, d + 1) for d in range(dims)]
    flipped = [first.bitwiseXOR(low), *others[1:]]
    swapped = [x.bitwiseXOR(swap) if d in (0, axis) and axis else x for d, x in enumerate(others)]
    return F.when(here.bitwiseAND(step) != 0, F.array(*flipped)).otherwise(F.array(*swapped))


def hilbert_index(axes: Column, dims: int, bits: int) -> Column:
    """Index on the curve of a point given as an array of `dims` longs below 2**bits.

    Undoes the rotations from the highest bit down, takes the Gray code across the
    axes, and interleaves the bits.
    """
    steps = F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)])
    levels = F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, -1, -1)])
    zero = F.lit(0).cast("long")

    def turns(point: Column, step: Column) -> Column:
        return around(point, step, 0)

    def around(point: Column, step: Column, axis: int) -> Column:
        if axis == dims:
            return point
        return _let(_turn(point, axis, step, dims), lambda p: around(p, step, axis + 1))

    def coded(point: Column) -> Column:
        return F.aggregate(F.slice(point, 2, dims), F.slice(point, 1, 1), lambda done, x: F.concat(
            done, F.array(x.bitwiseXOR(F.element_at(done, -1)))))

    def undone(gray: Column) -> Column:
        return F.aggregate(steps, zero, lambda t, s: F.when(
            F.element_at(gray, -1).bitwiseAND(s) != 0, t.bitwiseXOR(s - 1)).otherwise(t))

    def woven(gray: Column, undo: Column) -> Column:
        return F.aggregate(levels, zero, lambda acc, s: F.aggregate(gray, acc, lambda a, x: a * 2 + F.when(
            x.bitwiseXOR(undo).bitwiseAND(s) != 0, 1).otherwise(0).cast("long")))

    return _let(F.aggregate(steps, axes, turns), lambda point: _let(coded(point), lambda gray: _let(
        undone(gray), lambda undo: woven(gray, undo))))


def _levels(rows: DataFrame, column: str, bits: int) -> DataFrame:
    """(value, level): the distinct values of a column spread in sort order over 2**bits levels.

    Levels follow the order of the values, so a level is a range that min / max
    statistics can tell apart.  One row per distinct metadata value goes
    through the window; nulls sort first.
    """
    values = rows.select(F.col(column).alias(f"_v_{column}")).distinct()
    place = F.row_number().over(Window.orderBy(f"_v_{column}")) - 1
    level = F.floor(place * (1 << bits) / F.count(F.lit(1)).over(Window.partitionBy()))
    return values.select(f"_v_{column}", level.cast("long").alias(f"_l_{column}"))


def size_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def size_level(size: Column, largest: int, bits: int) -> Column:
    """Logarithm of a size of at least 8, in 2**bits steps up to the largest."""
    step = F.floor(F.log2(size / 8) / F.log2(F.lit(largest / 8 + 1)) * (1 << bits))
    return F.least(step, F.lit((1 << bits) - 1)).cast("long")


def shard_by_hilbert(docs: DataFrame, shards: int = 24, bits: int = 5) -> DataFrame:
    """Documents in `shards` runs of the Hilbert curve through (source, lang, size).

    Per row: doc_id, text_hash, size, text_crc32, curve, shard, slot.  Each dimension is quantised
    to 2**bits levels, rows are sorted by (curve index, hash of doc_id, doc_id, hash of
    the text) and cut into runs whose counts differ by one at most; `slot` counts from 0
    in each run.  A file written per shard then covers few sources, languages
    and sizes, so that readers skip files by any of the three.  Null metadata
    values are a value of their own, null texts have 8 bytes and the checksum of the
    empty text.  A table of fewer rows than shards fills the first ones.
    The curve index is computed once per cell, of which there are at most
    2**(3 * bits); the cells' table is bounded by that and broadcast.  Repeated rows
    follow each other.
    """
    return _placed(docs, [], shards, bits)


def _placed(docs: DataFrame, more: list[Column], shards: int, bits: int) -> DataFrame:
    """As `shard_by_hilbert`, with `more` columns, which put rows of equal id and text in order."""
    rows = settle(docs.select(
        F.col("doc_id"), F.xxhash64("text").alias("text_hash"), size_bytes(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        tie_hash(F.col("doc_id")).alias("tie"), *more))
    last = [c for c in rows.columns if c not in ("size", "text_crc32", "source", "lang", "tie")]
    total, largest = rows.agg(F.count(F.lit(1)), F.max("size")).first()
    total = max(total, 1)
    rows = rows.withColumn("_l_size", size_level(F.col("size"), largest or 8, bits))
    for column in ("source", "lang"):
        levels = _levels(rows, column, bits)
        rows = rows.join(levels, rows[column].eqNullSafe(levels[f"_v_{column}"]), "left").drop(f"_v_{column}")
    axes = ["_l_source", "_l_lang", "_l_size"]
    cells = rows.select(*axes).distinct().withColumn(
        "curve", hilbert_index(F.array(*[F.col(a) for a in axes]), len(axes), bits))
    rows = rows.join(F.broadcast(cells), axes).drop(*axes, "source", "lang")
    placed = positions(rows, [], "curve", "tie", last)
    # Whole numbers only: the first position of shard s is ceil(s * total / shards).
    shard = F.expr(f"position * {shards} div {total}")
    start = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (placed.withColumn("shard", shard).withColumn("slot", F.col("position") - start)
            .withColumn("shard", F.col("shard").cast("int")).drop("position", "tie"))


def write_shards(docs: DataFrame, path: str, shards: int = 24, bits: int = 5) -> None:
    """The documents themselves, one folder per shard, in curve order."""
    whole = whole_hash(docs)
    placed = _placed(docs, [whole.alias("_whole")], shards, bits).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_whole",
        F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    # Rows equal in all columns are interchangeable; any other finds its own place.
    order = Window.partitionBy("_id", "_hash", "_whole")
    placed = placed.withColumn("_k", F.row_number().over(order.orderBy("_shard", "_slot")))
    rows = docs.select(carried(docs).alias("_row"), F.col("doc_id").alias("_d"), F.xxhash64("text").alias("_h"),
                       whole.alias("_w"))
    rows = rows.withColumn("_j", F.row_number().over(Window.partitionBy("_d", "_h", "_w").orderBy("_h")))
    same = (rows["_d"].eqNullSafe(placed["_id"]) & (rows["_h"] == placed["_hash"]) & (rows["_w"] == placed["_whole"])
            & (rows["_j"] == placed["_k"]))
    (rows.join(placed, same).repartition(shards, "_shard").sortWithinPartitions("_shard", "_slot")
     .select("_row.*", F.col("_shard").alias("shard")).write.partitionBy("shard").parquet(path))
