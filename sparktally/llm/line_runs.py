"""Line dedup against levelled sorted runs of line hashes."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparktally.llm.common import SPACE, carried, settle
from sparktally.session import discard, scratch_path

#: Code points that a key needs to be compared at all.
SHORTEST = 10
#: Batches in which a table is taken, in order of doc_id.
BATCHES = 4
#: Runs of a level that are merged into one of the next.
FANOUT = 2
_KEY = ["h1", "h2"]
_NO_ID = (1 << 63) - 1


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACE)), string.ascii_uppercase, string.ascii_lowercase)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _order_id(doc_id: Column) -> Column:
    """Rows without an id come last and count as one document."""
    return F.coalesce(doc_id.cast("long"), F.lit(_NO_ID))


class LineRuns:
    """Hashes of the lines seen so far, as sorted runs on levels.

    A run is a table bucketed and sorted by its 128-bit line hash, so a batch
    that is hashed and sorted once merges with every run as it lies.
    No hash is in two runs.  FANOUT runs of one level are merged into one run
    of the next; a hash is so rewritten a logarithmic number of times.
    """

    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def runs(self) -> list[str]:
        """Names of all run tables, the largest first."""
        return [name for level in reversed(self.levels) for name in level]

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The rows of `keys` that no run holds."""
        for name in self.runs():
            keys = keys.join(self.spark.table(name).hint("merge"), _KEY, "left_anti")
        return keys

    def add(self, keys: DataFrame) -> None:
        """Keys, none of them in a run, become a run of the lowest level."""
        self._put(0, self._write(keys.select(*_KEY)))

    def _put(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            parts, self.levels[level] = self.levels[level], []
            merged = self.spark.table(parts[0])
            for part in parts[1:]:
                merged = merged.unionAll(self.spark.table(part))
            self._put(level + 1, self._write(merged))
            for part in parts:
                self._drop(part)

    def _write(self, keys: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (keys.repartition(self.buckets, *_KEY).write.format("parquet")
         .bucketBy(self.buckets, *_KEY).sortBy(*_KEY).option("path", f"{self.folder}/{name}").saveAsTable(name))
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        discard(self.spark, f"{self.folder}/{name}")

    def close(self) -> None:
        for name in self.runs():
            self._drop(name)
        self.levels = []


def hashed_lines(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc, text_hash, place, h1, h2 of every line whose key is long enough to count."""
    rows = docs.select(_order_id(F.col("doc_id")).alias("doc"), F.xxhash64("text").alias("text_hash"),
                       F.posexplode(_lines(F.col("text"))).alias("place", "line"))
    key = line_key(F.col("line"))
    rows = rows.select("doc", "text_hash", "place", key.alias("key")).where(F.length("key") >= shortest)
    # Two hashes of unlike seed: 128 bits, so that no two lines of a corpus meet by chance.
    return rows.select("doc", "text_hash", "place", F.xxhash64("key").alias("h1"),
                       F.xxhash64(F.lit("second"), F.col("key")).alias("h2"))


def dropped_lines(lines: DataFrame, runs: LineRuns) -> DataFrame:
    """The lines of a batch that go; its new keys become a run.

    Batches come in ascending order of document, so a key that a run holds has
    its smallest document in an earlier batch and loses all its lines here.
    A new key keeps its lines in its smallest document.  The keys are reduced
    to one row each before they meet the runs; the verdicts are written, so
    that a line found in a third of all documents is a skewed join that
    Spark splits.
    """
    keys = settle(lines.groupBy(*_KEY).agg(F.min("doc").alias("first"), F.max("doc").alias("last")))
    fresh = settle(runs.unseen(keys))
    known = keys.join(fresh.select(*_KEY), _KEY, "left_anti").select(*_KEY, F.lit(-1).cast("long").alias("owner"),
                                                                    F.lit(True).alias("gone"))
    shared = fresh.where("first < last").select(*_KEY, F.col("first").alias("owner"), F.lit(False).alias("gone"))
    verdicts = settle(known.unionAll(shared))
    runs.add(fresh)
    return (lines.join(verdicts, _KEY).where("gone or doc != owner").select("doc", "text_hash", "place"))


def dedup_lines(docs: DataFrame, batches: int = BATCHES, shortest: int = SHORTEST,
                fanout: int = FANOUT) -> DataFrame:
    """`docs` with the text cut, and the columns n_lines and n_dropped.

    A line's key is the line without white space at its ends, A-Z lower-cased.
    Keys of at least `shortest` code points that are in two documents or more lose
    their lines in all but the one of smallest doc_id, repeats there
    stay.  A null or empty text has one empty line; a text that loses nothing
    is returned as it is, null included.  Rows of one doc_id are one
    document; rows without an id come last and count as one.  Columns named
    n_lines and n_dropped are replaced.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "line-runs")
    ids = docs.select(_order_id(F.col("doc_id")).alias("doc"))
    shares = [i / batches for i in range(1, batches)]
    cuts = sorted(set(ids.agg(F.percentile_approx("doc", shares, 10_000)).first()[0] or []))
    batch = sum([(F.col("doc") > F.lit(cut)).cast("int") for cut in cuts], F.lit(0))
    hashed_lines(docs, shortest).withColumn("batch", batch).write.partitionBy("batch").parquet(f"{folder}/lines")
    lines = spark.read.schema("doc long, text_hash long, place int, h1 long, h2 long, batch int"
                              ).parquet(f"{folder}/lines")
    runs = LineRuns(spark, folder, fanout)
    try:
        for b in range(len(cuts) + 1):
            one = lines.where(F.col("batch") == b).drop("batch")
            dropped_lines(one, runs).write.mode("append").parquet(f"{folder}/dropped")
    finally:
        # Runs are tables of a catalogue that others may share.
        runs.close()
    dropped = spark.read.schema("doc long, text_hash long, place int").parquet(f"{folder}/dropped")
    # Equal rows are dropped alike: their places are one set.
    gone = settle(dropped.groupBy("doc", "text_hash").agg(F.collect_set("place").alias("_gone")))
    discard(spark, folder)
    rows = docs.select(carried(docs).alias("_row"), _order_id(F.col("doc_id")).alias("doc"),
                       F.xxhash64("text").alias("text_hash"))
    joined = rows.join(gone, ["doc", "text_hash"], "left")
    text, cut = F.col("_row.text"), F.col("_gone")
    own = {"n_lines": F.size(_lines(text)).cast("long"),
           "n_dropped": F.coalesce(F.size(cut), F.lit(0)).cast("long"),
           "text": F.when(cut.isNull(), text).otherwise(kept_text(text, cut))}
    columns = {c: F.col(f"_row.`{c}`") for c in docs.columns} | own
    return joined.select(*[column.alias(name) for name, column in columns.items()])


def kept_text(text: Column, gone: Column) -> Column:
    """The lines of `text` but those at the places `gone`, joined again."""
    def cut(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(stay, lambda i: F.element_at(lines, i + 1)), "\n")

    return F.element_at(F.transform(F.array(_lines(text)), cut), 1)
