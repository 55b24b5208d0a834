"""A store that holds one record per key, whatever is sent again.

Records lie in folders by day.  A merge writes what the days concerned do not
hold yet into a folder of its own, and then commits it: the commit lists, for every
day, the folders that make it up.  Readers see whole commits only, so a
merge that dies half-way leaves nothing, and a batch that is replayed
finds its records there.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from sparktally.plans.frames import detection_time
from sparktally.session import discard, exists

#: Folders of a day from which a merge writes the day anew as one.
MOST_FOLDERS = 8
_COMMIT = "commit long, day string, folders array<bigint>"
#: The day of records whose time cannot be read.
NO_DAY = "none"


def record_day(timestamp: Column) -> Column:
    """The UTC day of an ISO time, as text."""
    return F.coalesce(F.date_format(detection_time(timestamp), "yyyy-MM-dd"), F.lit(NO_DAY))


class KeyedStore:
    """Records of `schema`, one per key, by day.

    A repeat is a record of equal key and day; the one stored first stays.  Of
    repeats within one merge a hash of the row decides.  Records without
    a key are told apart by all their columns.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "frame_id",
                 day: Callable[[Column], Column] = record_day, ts: str = "timestamp", most_folders: int = MOST_FOLDERS):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.day, self.ts, self.most_folders = key, day, ts, most_folders

    # ---- commits ---------------------------------------------------------

    def _commits(self) -> DataFrame:
        if not exists(self.spark, f"{self.path}/commits"):
            return self.spark.createDataFrame([], _COMMIT)
        return self.spark.read.schema(_COMMIT).option("recursiveFileLookup", True).parquet(f"{self.path}/commits")

    def last_commit(self) -> int:
        """Number of the last commit, 0 for a store without any."""
        return self._commits().agg(F.max("commit")).first()[0] or 0

    def _folders(self, commit: int) -> dict[str, list[int]]:
        return {r.day: list(r.folders) for r in self._commits().where(F.col("commit") == commit).collect()}

    def _commit(self, number: int, folders: dict[str, list[int]]) -> None:
        """One file holds the whole commit and appears at once when its job ends."""
        rows = [(number, day, numbers) for day, numbers in sorted(folders.items())]
        (self.spark.createDataFrame(rows, _COMMIT).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.path}/commits/{number:012d}"))

    # ---- records ---------------------------------------------------------

    def _read(self, folders: dict[str, list[int]]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("day", T.StringType())])
        paths = [f"{self.path}/data/folder={n}/day={day}" for day, numbers in folders.items() for n in numbers]
        if not paths:
            return self.spark.createDataFrame([], schema)
        # The day is text: dates are not to be guessed from folder names.
        stored = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths)
        return stored.select(*schema.fieldNames())

    def read(self, first_day: str | None = None, last_day: str | None = None, commit: int | None = None) -> DataFrame:
        """The records as of a commit, the last one if not named; only folders of the days asked for are read."""
        folders = self._folders(self.last_commit() if commit is None else commit)
        asked = {d: n for d, n in folders.items()
                 if (first_day is None or d >= first_day) and (last_day is None or d <= last_day)}
        return self._read(asked).drop("day")

    def _identity(self) -> Column:
        row = F.md5(F.to_json(F.struct(*self.schema.fieldNames()), {"ignoreNullFields": "false"}))
        return F.coalesce(F.concat(F.lit("k"), F.col(self.key).cast("string")), F.concat(F.lit("r"), row))

    def merge(self, records: DataFrame, batch_id: int | None = None) -> int:
        """Add the records whose key their day does not hold; returns how many there were.

        Reads the days of the records only.  A day of more than `most_folders` folders
        is written anew as one by the merge that finds it so.  The batch
        id is not needed: what a batch has left is known by its keys.
        """
        names = self.schema.fieldNames()
        rows = records.select(*names).withColumn("day", self.day(F.col(self.ts))).withColumn("_id", self._identity())
        days = [r.day for r in rows.select("day").distinct().collect()]
        last = self.last_commit()
        folders = self._folders(last)
        held = {d: folders[d] for d in days if d in folders}
        one = F.min_by(F.struct(*names), F.xxhash64(*names)).alias("_row")
        fresh = rows.groupBy("day", "_id").agg(one)
        if held:
            known = self._read(held).withColumn("_id", self._identity()).select("day", "_id")
            fresh = fresh.join(known, ["day", "_id"], "left_anti")
        fresh = fresh.select("_row.*", "day")
        full = {d: n for d, n in held.items() if len(n) >= self.most_folders}
        number, seen = last + 1, Observation()
        out = fresh.observe(seen, F.count(F.lit(1)).alias("added"))
        out = out.unionByName(self._read(full)) if full else out
        path = f"{self.path}/data/folder={number}"
        out.write.mode("overwrite").partitionBy("day").parquet(path)
        if not seen.get["added"]:
            discard(self.spark, path)
            return 0
        written = self.spark.read.option("basePath", path).schema("day string").parquet(path).distinct()
        for day in [r.day for r in written.collect()]:
            folders[day] = [number] if day in full else [*folders.get(day, []), number]
        self._commit(number, folders)
        return seen.get["added"]

    def writer(self) -> Callable[[DataFrame, int], None]:
        """For `store_batches`."""
        return lambda batch, batch_id: self.merge(batch, batch_id) and None

    def vacuum(self, keep: int = 2) -> None:
        """Delete all commits but the last `keep`, and folders that none of those lists."""
        commits = [r.commit for r in self._commits().select("commit").distinct().orderBy("commit").collect()]
        used = {n for c in commits[-keep:] for numbers in self._folders(c).values() for n in numbers}
        for c in commits[:-keep]:
            listed = {n for numbers in self._folders(c).values() for n in numbers}
            discard(self.spark, f"{self.path}/commits/{c:012d}")
            for n in listed - used:
                discard(self.spark, f"{self.path}/data/folder={n}")

