"""Means that are kept between loads as (sum, count), so that a load reads new files only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from sparktally.operators.aggregates import COUNT, TOTAL, finish_mean, merge_partials, partial_mean
from sparktally.session import exists


class MeansStore:
    """Partial means of `value` per key, one folder per load, below `path`.

    A load writes its partials, and then the list of the files they are of;
    what is not listed is not read, so a load that dies leaves nothing.  A file is
    known by its path, and is not read again.  Sums of doubles that are no
    whole multiples of a power of two depend on how the files fell into loads, by rounding.
    One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], value: str):
        self.spark, self.path, self.keys, self.value = spark, path.rstrip("/"), list(keys), value

    def _loads(self) -> DataFrame:
        schema = "load int, file string"
        if not exists(self.spark, f"{self.path}/loads"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{self.path}/loads")

    def load(self, files: Sequence[str], read: Callable[[list[str]], DataFrame]) -> list[str]:
        """Add the files that no load had; returns those."""
        asked = self.spark.createDataFrame([(f,) for f in dict.fromkeys(files)], "file string")
        new = [r.file for r in asked.join(self._loads(), "file", "left_anti").orderBy("file").collect()]
        if not new:
            return []
        number = (self._loads().agg(F.max("load")).first()[0] or 0) + 1
        partial_mean(read(new), self.keys, self.value).write.mode("overwrite").parquet(f"{self.path}/parts/load={number}")
        listed = self.spark.createDataFrame([(number, f) for f in new], "load int, file string")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/loads/{number}")
        return new

    def partials(self) -> DataFrame | None:
        """keys, sum and count over all loads; None before the first."""
        loads = [r.load for r in self._loads().select("load").distinct().orderBy("load").collect()]
        if not loads:
            return None
        parts = self.spark.read.parquet(*[f"{self.path}/parts/load={n}" for n in loads])
        return merge_partials(parts, self.keys)

    def means(self, mean: str = "avg_rating", n: str | None = "n_ratings", precision: str = "double") -> DataFrame:
        parts = self.partials()
        if parts is None:
            empty = T.StructType([*[T.StructField(k, T.StringType()) for k in self.keys],
                                  T.StructField(TOTAL, T.DoubleType()), T.StructField(COUNT, T.LongType())])
            parts = self.spark.createDataFrame([], empty)
        return finish_mean(parts, mean, n, precision)
