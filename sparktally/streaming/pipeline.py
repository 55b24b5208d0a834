"""Frame messages in, detection records out, detections stored.

Each stage is its own query with its own checkpoint, so stages restart and
scale apart.  The file source and sink are exactly-once by their checkpoint;
`store_batches` makes any other store idempotent by the batch id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparktally import schemas
from sparktally.operators.rejects import Rejects
from sparktally.plans.frames import CONFIDENCE, Scorer, detect_people

#: New files that one batch takes, so that a backlog is not one batch.
MAX_FILES = 1000
_CORRUPT = T.StructField("_malformed_message", T.StringType())
Detect = Callable[[DataFrame], DataFrame]


def read_message_stream(spark: SparkSession, schema: T.StructType, source: str = "file",
                        path: str | None = None, servers: str | None = None,
                        topic: str | None = None, starting_offsets: str = "latest",
                        max_files: int | None = None, max_offsets: int | None = None,
                        malformed: bool = False, archive: str | None = None) -> DataFrame:
    """JSON messages as rows; missing keys are null, malformed messages are left out.

    With `malformed` the raw text of just those, in `value`, blank lines included.

    source='file'   a folder of JSON-lines files; files that are done with are moved to `archive`, if
                    given, so that the folder's listing stays short (one reader per folder then)
    source='kafka'  a topic, from `starting_offsets` on the first run and from
                    the checkpoint later (needs Spark's Kafka package)
    """
    if source == "file":
        reader = spark.readStream
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        if archive is not None:
            reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
        values = reader.text(path)
    elif source == "kafka":
        reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
                  .option("subscribe", topic).option("startingOffsets", starting_offsets))
        if max_offsets is not None:
            reader = reader.option("maxOffsetsPerTrigger", max_offsets)
        values = reader.load().select(F.col("value").cast("string").alias("value"))
    else:
        raise ValueError(f"unknown source {source!r}")
    tried, broken = _tried(values, schema)
    if malformed:
        return tried.where(broken).select("value")
    return tried.where(~broken).select("_m.*").drop(_CORRUPT.name)


def _tried(values: DataFrame, schema: T.StructType) -> tuple[DataFrame, Column]:
    """`value` read as JSON into `_m`, and whether that failed."""
    tried = values.withColumn("_m", F.from_json(
        "value", T.StructType([*schema.fields, _CORRUPT]),
        {"columnNameOfCorruptRecord": _CORRUPT.name}))
    return tried, F.col("_m").isNull() | F.col(f"_m.{_CORRUPT.name}").isNotNull()


def sorted_messages(schema: T.StructType) -> Callable[[DataFrame, Rejects], DataFrame]:
    """For `checked_batches`: the messages in `value` as kind 'record', what is no JSON as kind 'malformed'."""
    def sort_out(batch: DataFrame, rejects: Rejects) -> DataFrame:
        tried, broken = _tried(batch.select("value"), schema)
        watched = rejects.watch(tried, n_malformed=broken)
        return watched.select(F.when(broken, F.col("value")).alias("value"),
                              *[F.when(~broken, F.col(f"_m.{f}")).alias(f) for f in schema.fieldNames()],
                              F.when(broken, "malformed").otherwise("record").alias("kind"))
    return sort_out


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON text in `value`, the topic form of a record."""
    body = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(body) if key is None else df.select(F.col(key).cast("string").alias("key"), body)


def _start(writer, available_now: bool, interval: str | None) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval is not None:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def write_message_stream(stream: DataFrame, checkpoint: str, sink: str = "file",
                         path: str | None = None, servers: str | None = None,
                         topic: str | None = None, key: str | None = None,
                         available_now: bool = False, interval: str | None = None) -> StreamingQuery:
    """Publish rows as JSON messages to a folder or a topic."""
    if sink == "file":
        writer = to_messages(stream).writeStream.format("text").option("path", path)
    elif sink == "kafka":
        writer = (to_messages(stream, key).writeStream.format("kafka")
                  .option("kafka.bootstrap.servers", servers).option("topic", topic))
    else:
        raise ValueError(f"unknown sink {sink!r}")
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    return _start(writer, available_now, interval)


def without_repeats(records: DataFrame, key: str = "frame_id", ts: str = "ts",
                    horizon: str = "1 hour") -> DataFrame:
    """Drop records whose key was seen within the horizon; state older than it is freed."""
    return records.withWatermark(ts, horizon).dropDuplicatesWithinWatermark([key])


def store_detections(records: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                     available_now: bool = False, interval: str | None = None) -> StreamingQuery:
    """Append every record to the detection store (parquet or json)."""
    writer = (records.writeStream.format(fmt).outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    return _start(writer, available_now, interval)


def store_batches(records: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  available_now: bool = False, interval: str | None = None,
                  output_mode: str = "append") -> StreamingQuery:
    """Hand each batch and its id to `write`, which must replace what that id left before."""
    writer = (records.writeStream.foreachBatch(write).outputMode(output_mode)
              .option("checkpointLocation", checkpoint))
    return _start(writer, available_now, interval)


def replace_batch(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A `store_batches` writer: one folder per batch id, replaced when the batch is repeated."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")
    return write


def dropped_late(query: StreamingQuery) -> int:
    """Rows that the watermark has left out of a finished query's state, over all its batches."""
    progress = query.recentProgress
    kept = int(query._jsq.sparkSession().conf().get("spark.sql.streaming.numRecentProgressUpdates", "100"))
    if len(progress) >= kept:
        raise RuntimeError("not all batches can be seen; raise spark.sql.streaming.numRecentProgressUpdates")
    return sum(s.numRowsDroppedByWatermark for p in progress for s in p.stateOperators)


def finish_complete(query: StreamingQuery) -> None:
    """Wait for a query over waiting data and raise if its result depends on how that fell into batches.

    A row later than the watermark is dropped by Spark without a word.  A
    stream whose rows come that much out of order needs a longer horizon, and
    a bounded backfill the batch function.
    """
    query.awaitTermination()
    if late := dropped_late(query):
        raise RuntimeError(f"{late} rows came later than the watermark and are missing from the result")


def _detect_stage(spark, raw_path, result_path, checkpoint, detect, max_files, **when):
    raw = read_message_stream(spark, schemas.RAW_FRAME, path=raw_path, max_files=max_files)
    return write_message_stream(detect(raw), f"{checkpoint}/detect", path=result_path, **when)


def _store_stage(spark, result_path, store_path, checkpoint, max_files, **when):
    results = read_message_stream(spark, schemas.DETECTION_RECORD, path=result_path, max_files=max_files)
    return store_detections(results, store_path, f"{checkpoint}/store", **when)


def _reject_stage(spark, raw_path, reject_path, checkpoint, max_files, **when):
    broken = read_message_stream(spark, schemas.RAW_FRAME, path=raw_path, max_files=max_files, malformed=True)
    writer = (broken.writeStream.format("text").option("path", reject_path).outputMode("append")
              .option("checkpointLocation", f"{checkpoint}/reject"))
    return _start(writer, when.get("available_now", False), when.get("interval"))


def _detector(factory, threshold, detect) -> Detect:
    if (factory is None) == (detect is None):
        raise ValueError("give either a model factory or a detect function")
    return detect or (lambda raw: detect_people(raw, factory, threshold))


def run_pipeline(spark: SparkSession, raw_path: str, result_path: str, store_path: str,
                 checkpoint: str, factory: Callable[[], Scorer] | None = None,
                 threshold: float = CONFIDENCE, max_files: int | None = MAX_FILES,
                 detect: Detect | None = None, reject_path: str | None = None) -> None:
    """Process all waiting raw-frame messages through detection into the store, then stop.

    Two queries decoupled by the result folder: messages -> detection
    messages, detection messages -> store.  A second run continues after the
    last committed message.  Detection is by the factory's model, or by
    `detect`, raw messages to records.  Messages that are no JSON go to
    `reject_path`, one per line, if it is given.
    """
    found = _detector(factory, threshold, detect)
    _detect_stage(spark, raw_path, result_path, checkpoint, found, max_files, available_now=True).awaitTermination()
    if reject_path is not None:
        _reject_stage(spark, raw_path, reject_path, checkpoint, max_files, available_now=True).awaitTermination()
    _store_stage(spark, result_path, store_path, checkpoint, max_files,
                 available_now=True).awaitTermination()


def start_pipeline(spark: SparkSession, raw_path: str, result_path: str, store_path: str,
                   checkpoint: str, factory: Callable[[], Scorer] | None = None, threshold: float = CONFIDENCE,
                   max_files: int | None = MAX_FILES, interval: str = "2 seconds",
                   detect: Detect | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """The same two queries running side by side until the caller stops them."""
    # The second stage watches the result folder, which must exist by then.
    spark.createDataFrame([], "value string").write.mode("append").text(result_path)
    detect = _detect_stage(spark, raw_path, result_path, checkpoint, _detector(factory, threshold, detect), max_files,
                           interval=interval)
    store = _store_stage(spark, result_path, store_path, checkpoint, max_files, interval=interval)
    return detect, store
