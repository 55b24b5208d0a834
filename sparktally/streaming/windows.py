"""Window sums of a stream that lose no record, however late it comes.

A window is handed out once the watermark has passed its end.  A record behind
the watermark is not dropped: it goes to a side table, and reading the windows
adds it to the one it belongs to.  Nothing that was written is changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from sparktally.streaming.pipeline import _start

#: Keys of the state; fixed for the life of a checkpoint.  A task holds the open windows of one key at a time.
BUCKETS = 256
#: Records of a batch that one bucket should have on average, for who sets the number of buckets by the size of a batch.
BUCKET_RECORDS = 50_000
#: Buckets that the records of one camera are spread over.
SHARES = 8
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE = ("windows array<struct<camera_id:string, start:bigint, frames:bigint, counted:bigint, people:bigint, "
          "max_people:int, seen:array<string>, closed:boolean>>")
_OUT = ("kind string, camera_id string, start bigint, frames bigint, counted bigint, people bigint, max_people int, "
        "frame_id string, at bigint, person_count int")
_COLUMNS = [c.split()[0] for c in _OUT.split(", ")]
_STORED = ("camera_id string, window_start timestamp, window_end timestamp, frames bigint, counted bigint, people bigint, "
           "max_people int, frame_id string, ts timestamp, person_count int, kind string")


def _micros(spark: SparkSession, interval: str) -> int:
    return spark.sql(f"SELECT unix_micros(timestamp_micros(0) + interval {interval})").first()[0]


class _Sums(StatefulProcessor):
    """The windows of one bucket: summed while open, handed out when closed, remembered for a while after."""

    def __init__(self, width: int, keep: int):
        self.width, self.keep = width, keep

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("windows", _STATE)

    def _held(self) -> dict:
        rows = self.state.get()[0] if self.state.exists() else []
        return {(r[0], r[1]): [*r[2:6], set(r[6]), r[7]] for r in rows}

    def _hold(self, held: dict) -> None:
        """Keep the state, and a timer for the next window that ends or is to be forgotten."""
        if not held:
            self.state.clear()
            return
        self.state.update(([(*key, *w[:4], sorted(w[4]), w[5]) for key, w in held.items()],))
        due = min(start + self.width + (self.keep if w[5] else 0) for (_, start), w in held.items())
        self.handle.registerTimer(-(-due // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        held, late = self._held(), []
        for batch in rows:
            batch = batch.astype(object).where(batch.notna(), None)
            for camera, start, frame, at, n in zip(*[batch[c] for c in ("camera_id", "start", "frame_id", "at", "person_count")]):
                window = held.get((camera, start))
                if window is not None and frame is not None and frame in window[4]:
                    continue  # a repeat
                if window is None and start + self.width > watermark:
                    window = held[camera, start] = [0, 0, 0, None, set(), False]
                if window is not None and frame is not None:
                    window[4].add(frame)
                if window is None or window[5]:
                    late.append(("late", camera, start, None, None, None, None, frame, at, n))
                    continue
                window[0] += 1
                if n is not None:
                    window[1], window[2] = window[1] + 1, window[2] + int(n)
                    window[3] = int(n) if window[3] is None else max(window[3], int(n))
        self._hold(held)
        if late:
            yield _table(late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        held, done = {}, []
        for (camera, start), window in self._held().items():
            end = start + self.width
            if end <= watermark and not window[5]:
                done.append(("window", camera, start, *window[:4], None, None, None))
                window[5] = True
            if not window[5] or end + self.keep > watermark:
                held[camera, start] = window
        self._hold(held)
        if done:
            yield _table(done)

    def close(self) -> None:
        pass


def _table(rows: list[tuple]) -> pd.DataFrame:
    table = pd.DataFrame(rows, columns=_COLUMNS, dtype=object)
    whole = {"start", "frames", "counted", "people", "at"}
    return table.astype({c: "Int64" if c in whole else "Int32" for c in _COLUMNS if c in whole | {"max_people", "person_count"}})


def window_sums(records: DataFrame, width: str = "10 minutes", horizon: str = "10 minutes", keep: str = "1 day",
                ts: str = "ts", buckets: int = BUCKETS) -> DataFrame:
    """A stream of closed windows (kind 'window') and of records that came behind the watermark (kind 'late').

    A window closes when the watermark, `horizon` behind the newest record, passes its
    end; a window may have one row per share of its camera.  A frame that comes twice counts
    once: repeats are known while their window is open and for `keep` after, and
    late ones among each other for good (see `corrected_windows`).  Records
    without a time belong to no window.
    """
    spark = records.sparkSession
    # State of this kind needs Spark's RocksDB store, which `build_session` sets; another session is given it here.
    if "RocksDB" not in spark.conf.get(_PROVIDER, ""):
        spark.conf.set(_PROVIDER, _ROCKSDB)
    width_us, keep_us = _micros(spark, width), _micros(spark, keep)
    share = F.pmod(F.xxhash64("frame_id"), F.lit(SHARES))
    rows = records.where(F.col(ts).isNotNull()).withWatermark(ts, horizon).select(
        F.pmod(F.xxhash64("camera_id", share), F.lit(buckets)).cast("int").alias("bucket"), "camera_id",
        # Plain numbers: Spark drops late rows by the time column itself.
        F.unix_micros(F.window(ts, width)["start"]).alias("start"), "frame_id", F.unix_micros(ts).alias("at"),
        F.col("person_count").cast("int").alias("person_count"))
    out = rows.groupBy("bucket").transformWithStateInPandas(_Sums(width_us, keep_us), _OUT, "Append", "EventTime")
    start = F.timestamp_micros("start")
    return out.select("camera_id", start.alias("window_start"), F.timestamp_micros(F.col("start") + width_us).alias("window_end"),
                      "frames", "counted", "people", "max_people", "frame_id", F.timestamp_micros("at").alias("ts"),
                      "person_count", "kind")


def store_window_sums(sums: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                      interval: str | None = None) -> StreamingQuery:
    """Closed windows and late records, each appended to its own folder below `path`, exactly once."""
    writer = (sums.writeStream.format("parquet").partitionBy("kind").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    return _start(writer, available_now, interval)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_STORED).option("basePath", path).parquet(path)


def late_records(spark: SparkSession, path: str) -> DataFrame:
    """The side table: camera_id, window_start, window_end, frame_id, ts, person_count; a repeated frame once.

    Only repeats have equal frame and window; records without a frame id are kept one by one.
    """
    late = _stored(spark, path).where("kind = 'late'").select(
        "camera_id", "window_start", "window_end", "frame_id", "ts", "person_count")
    named = late.where("frame_id is not null").dropDuplicates(["camera_id", "window_start", "frame_id"])
    return named.unionAll(late.where("frame_id is null"))


def open_windows(spark: SparkSession, checkpoint: str, width: str) -> DataFrame:
    """The sums of the windows that no watermark has passed yet, from the state of the query."""
    spark.streams.active  # the reader asks the session's streaming manager where state lives
    state = spark.read.format("statestore").option("stateVarName", "windows").load(checkpoint)
    held = state.select(F.explode("value.windows").alias("w")).where("not w.closed")
    end = F.timestamp_micros(F.col("w.start") + _micros(spark, width))
    return held.select("w.camera_id", F.timestamp_micros("w.start").alias("window_start"), end.alias("window_end"),
                       "w.frames", "w.counted", "w.people", "w.max_people")


def corrected_windows(spark: SparkSession, path: str, checkpoint: str | None = None, width: str = "10 minutes") -> DataFrame:
    """camera_id, window_start, window_end, frames, people, avg_people, max_people, late records included.

    With the checkpoint of the query also the windows that are still open, so
    that all records seen so far count, whatever the order in which they came.
    """
    sums = ["frames", "counted", "people", "max_people"]
    key = ["camera_id", "window_start", "window_end"]
    one = [F.lit(1).cast("bigint").alias("frames"), F.col("person_count").isNotNull().cast("bigint").alias("counted"),
           F.coalesce("person_count", F.lit(0)).cast("bigint").alias("people"), F.col("person_count").alias("max_people")]
    parts = (_stored(spark, path).where("kind = 'window'").select(*key, *sums)
             .unionAll(late_records(spark, path).select(*key, *one)))
    if checkpoint is not None:
        parts = parts.unionAll(open_windows(spark, checkpoint, width))
    added = parts.groupBy(*key).agg(*[F.sum(c).alias(c) for c in sums[:3]], F.max("max_people").alias("max_people"))
    counted = F.col("counted") > 0
    return added.select(*key, "frames", F.when(counted, F.col("people")).alias("people"),
                        F.when(counted, F.col("people") / F.col("counted")).alias("avg_people"), "max_people")
