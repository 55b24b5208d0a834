"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparktally.llm.common import TIE_BITS, carried, positions, settle, tie_hash, whole_hash, word_count

#: Weights of the sources by code point, null last, repeated as often as needed.
WEIGHTS = (5, 2, 1)
#: No source is taken more often than this.
MOST = 3
#: Random offsets drawn for each source; the one whose words come nearest the target is used.
OFFSETS = 16
#: Places in which the rows of one source meet what is known of it.
SPREAD = 64


def _source_key(source: Column) -> Column:
    """Sorts as the source does by code point, null last; never null itself."""
    return F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source.cast("string")))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(key, source_size) -> and `target`: the words to take from each source.

    Targets share the sum of all sizes by weight.  A target stops at `most`
    times its source's size; the excess is shared by weight among the
    others, until none is above.  That end is a water level: with the sources
    sorted by size per weight, the full ones are a prefix, and each other one gets
    its weight times what is left over per weight.  One row per source goes
    through these windows, never one per document.
    """
    by_key = Window.orderBy("key")
    place = (F.row_number().over(by_key) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int")).cast("long")
    full = F.col("source_size") * most
    filled = sizes.withColumn("weight", weight)
    order = Window.orderBy(full / F.col("weight"), "key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left_size = F.sum("source_size").over(everything) - F.coalesce(F.sum(full).over(before), F.lit(0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    filled = filled.withColumn("_level", left_size.cast("double") / left_weight)
    is_full = F.col("_level") * F.col("weight") >= full
    # The first source that is not full sets the level of all others.
    first_open = F.min(F.when(~is_full, F.struct(full / F.col("weight"), F.col("key"), F.col("_level")))
                       ).over(everything)
    target = F.when(is_full, full.cast("double")).otherwise(F.col("weight") * first_open["_level"])
    return filled.withColumn("target", target).drop("_level")


def copies_of(docs: DataFrame, seed: int = 17, weights: tuple[int, ...] = WEIGHTS,
              most: int = MOST) -> DataFrame:
    """How often the mix takes each row.

    Per row of `docs` (columns doc_id, text, source): doc_id, text_hash, key, size,
    source_size, target, copies.  A document's expected copies are target / source
    size, the same for all of a source.  In the order (size, hash of
    doc_id) their prefix sum, plus one random offset per source, crosses
    `copies` whole numbers at the document.  Sorting by size keeps the words
    taken within about one document of the target; the offset is the one of
    OFFSETS random ones whose words come nearest.  Null texts have
    size 0; a source without words has target 0 and is not taken.  Equal rows
    are counted one by one.  Hot sources and sizes are split, see `positions`.
    """
    return _copies(docs, [], seed, weights, most)


def _copies(docs: DataFrame, more: list[Column], seed: int, weights: tuple[int, ...], most: int) -> DataFrame:
    """As `copies_of`, with `more` columns, which put rows of equal id and text in order."""
    rows = docs.select(
        F.col("doc_id"), F.xxhash64("text").alias("text_hash"), _source_key(F.col("source")).alias("key"),
        word_count(F.col("text")).alias("size"), tie_hash(F.col("doc_id")).alias("tie"), *more)
    last = [c for c in rows.columns if c not in ("key", "size", "tie")]
    rows = settle(rows)
    sizes = rows.groupBy("key").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = settle(targets.select("key", "source_size", "target", rate.alias("rate")))
    spread = F.pmod(F.col("tie"), F.lit(SPREAD)).alias("spread")
    placed = settle(positions(rows, ["key"], "size", "tie", last).select("*", spread))
    drawn = [_crossed(_offset(seed, draw)) * F.col("size") for draw in range(OFFSETS)]
    words = (placed.join(_spread(targets), ["key", "spread"]).groupBy("key", "target")
             .agg(F.array(*[F.sum(w) for w in drawn]).alias("words")))
    miss = F.transform("words", lambda w, i: F.struct(F.abs(w - F.col("target")).alias("miss"), i.alias("draw")))
    nearest = words.select("key", F.array_min(miss)["draw"].alias("draw"))
    chosen = targets.join(nearest, "key").withColumn("_offset", _offset(seed, F.col("draw"))).drop("draw")
    return (placed.join(_spread(chosen), ["key", "spread"]).withColumn("copies", _crossed(F.col("_offset")))
            .drop("rate", "_offset", "position", "tie", "spread"))


def _spread(sources: DataFrame) -> DataFrame:
    """Each source SPREAD times, so that the rows of a hot one meet it in as many places."""
    return sources.withColumn("spread", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)).cast("array<long>")))


def _offset(seed: int, draw: int | Column) -> Column:
    """A number from 0 to below 1 for the source and the draw."""
    draw = F.lit(draw) if isinstance(draw, int) else draw
    text = F.concat(F.lit(f"{seed}:"), draw.cast("string"), F.lit(":"), F.col("key"))
    return tie_hash(text) / F.lit(float(1 << TIE_BITS))


def _crossed(offset: Column) -> Column:
    """Whole numbers that the prefix sum plus the offset crosses at a row."""
    place = F.col("position")
    return F.least(F.floor((place + 1) * F.col("rate") + offset) - F.floor(place * F.col("rate") + offset),
                   F.ceil("rate"))


def mix(docs: DataFrame, seed: int = 17, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mixed documents: every row of `docs` as often as the mix takes it.

    Rows equal in all columns are interchangeable: one of them stands for the copies
    of all.  Rows of equal id, text and source that differ elsewhere are ordered by a hash
    of the whole row and have copies of their own.  Columns are those of `docs`.
    """
    whole = whole_hash(docs)
    taken = (_copies(docs, [whole.alias("whole")], seed, weights, most).groupBy("doc_id", "text_hash", "key", "whole")
             .agg(F.sum("copies").alias("_copies")).where("_copies > 0"))
    rows = docs.select(carried(docs).alias("_row"), F.col("doc_id").alias("_id"),
                       F.xxhash64("text").alias("_hash"), _source_key(F.col("source")).alias("_key"),
                       whole.alias("_whole"))
    same = (rows["_id"].eqNullSafe(taken["doc_id"]) & (rows["_hash"] == taken["text_hash"])
            & (rows["_key"] == taken["key"]) & (rows["_whole"] == taken["whole"]))
    first = F.row_number().over(Window.partitionBy("_id", "_hash", "_key", "_whole").orderBy("_hash")) == 1
    return (rows.join(taken, same).withColumn("_first", first).where("_first")
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy"))
            .select("_row.*"))
