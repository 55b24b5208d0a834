"""Camera frames: message building, person detection, stored detections.

The same functions serve batch and streaming DataFrames, apart from those
that sort.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from sparktally.functions.formatting import iso_utc
from sparktally.functions.images import image_state

# A scorer maps a list of images (their bytes) to one entry per image: a list
# of (class, confidence, (x1, y1, x2, y2)), or None when the bytes cannot be
# decoded.  A factory loads the model.
Box = tuple[str, float, tuple[float, float, float, float]]
Scorer = Callable[[list[bytes]], "list[list[Box] | None]"]

PERSON = "person"
CONFIDENCE = 0.4
_BOXES = "array<struct<class:string,confidence:double,bbox:array<double>>>"


def _scorer(factory: Callable[[], Scorer], key: str) -> Scorer:
    """The model of this Python worker; a reused worker loads it once and keeps only the last.

    The model is kept with the interpreter, as this module itself may be
    shipped to the worker anew with every task.
    """
    models = vars(sys.modules.setdefault("_sparktally_models", ModuleType("_sparktally_models")))
    if key not in models:
        models.clear()
        models[key] = factory()
    return models[key]


def frame_id(*parts: Column) -> Column:
    """Identifier in UUID form that is the same when a lost task runs again."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.regexp_replace(digest, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def frames_to_messages(frames: DataFrame, camera_id: str = "cam01",
                       captured_at: Column | None = None) -> DataFrame:
    """Raw-frame messages from image files (path, modificationTime, length, content)."""
    at = F.current_timestamp() if captured_at is None else captured_at
    return frames.select(
        frame_id(F.col("path"), F.col("modificationTime").cast("string"),
                 F.col("length").cast("string")).alias("frame_id"),
        F.lit(camera_id).alias("camera_id"),
        iso_utc(at).alias("timestamp"),
        F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("image_format"),
        F.translate(F.base64("content"), "\r\n", "").alias("image_data"))


def _scored(factory: Callable[[], Scorer], key: str):
    """Arrow batches of (frame_id, camera_id, timestamp, payload) with the boxes found in place of the payload."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(factory, key)
        box = pa.struct([("class", pa.string()), ("confidence", pa.float64()), ("bbox", pa.list_(pa.float64()))])
        for batch in batches:
            found = [None if boxes is None else [(c, float(p), [float(x) for x in xy]) for c, p, xy in boxes]
                     for boxes in score(batch.column("payload").to_pylist())]
            columns = ["frame_id", "camera_id", "timestamp"]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + [pa.array(found, pa.list_(box))],
                                             names=[*columns, "boxes"])
    return run


def decoded_messages(messages: DataFrame) -> DataFrame:
    """frame_id, camera_id, timestamp, payload; messages without valid base64 are dropped."""
    return (messages.select("frame_id", "camera_id", "timestamp",
                            F.try_to_binary("image_data", F.lit("base64")).alias("payload"))
            .where(F.col("payload").isNotNull()))


def frame_faults(decoded: DataFrame) -> DataFrame:
    """The decoded messages with `fault`: null for a whole PNG or JPEG, else why its bytes are none."""
    return decoded.withColumn("fault", image_state(F.col("payload"))["fault"])


def undecodable_frames(messages: DataFrame) -> DataFrame:
    """frame_id, camera_id, timestamp, fault of the messages that hold no whole image.

    The fault is 'no base64' or one of those of `image_state`.
    """
    payload = F.try_to_binary("image_data", F.lit("base64"))
    read = messages.select("frame_id", "camera_id", "timestamp", payload.alias("payload"))
    fault = F.when(F.col("payload").isNull(), "no base64").otherwise(F.col("fault"))
    return frame_faults(read).withColumn("fault", fault).where("fault is not null").drop("payload")


def person_records(scored: DataFrame, threshold: float = CONFIDENCE) -> DataFrame:
    """Detection records of (frame_id, camera_id, timestamp, boxes); frames whose boxes are null are dropped.

    Person boxes at or above the threshold stay, rounded half to even to 2 decimals, confidences to 4.
    """
    kept = F.transform(keep_persons(F.col("boxes"), threshold), lambda b: F.struct(
        F.transform(b["bbox"], lambda x: F.bround(x, 2)).alias("bbox"),
        F.bround(b["confidence"], 4).alias("confidence"), b["class"].alias("class")))
    return (scored.where(F.col("boxes").isNotNull())
            .select("frame_id", "camera_id", "timestamp", kept.alias("detections"))
            .select("frame_id", "camera_id", "timestamp", F.size("detections").alias("person_count"), "detections"))


def detect_people(messages: DataFrame, factory: Callable[[], Scorer],
                  threshold: float = CONFIDENCE, model_key: str | None = None,
                  whole_images: bool = False) -> DataFrame:
    """Detection records of raw-frame messages; undecodable frames are dropped.

    The payload is decoded by Spark and scored one Arrow batch per call, with
    the model loaded once per Python worker; all else is done by Spark.
    `model_key` names the model; by default a digest of the factory does.
    With `whole_images` only payloads that are whole PNG or JPEG files reach the
    model; `undecodable_frames` lists the others.
    """
    key = model_key or hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()
    frames = decoded_messages(messages)
    if whole_images:
        frames = frame_faults(frames).where("fault is null").drop("fault")
    scored = frames.mapInArrow(
        _scored(factory, key), f"frame_id string, camera_id string, timestamp string, boxes {_BOXES}")
    return person_records(scored, threshold)


def keep_persons(detections: Column, threshold: float = CONFIDENCE) -> Column:
    """Person boxes at or above the threshold."""
    return F.filter(detections, lambda d: (d["class"] == PERSON) & (d["confidence"] >= threshold))


def latest_detections(store: DataFrame, limit: int | None = None) -> DataFrame:
    """Stored records, newest first by their ISO timestamp text."""
    ordered = store.orderBy(F.desc("timestamp"), F.asc("frame_id"))
    return ordered if limit is None else ordered.limit(limit)


def detection_boxes(store: DataFrame) -> DataFrame:
    """One row per box, numbered from 1; a frame without boxes keeps one row."""
    return store.select(
        "frame_id", "camera_id", "timestamp", "person_count",
        F.posexplode_outer("detections").alias("_pos", "_box")).select(
        "frame_id", "camera_id", "timestamp", "person_count",
        (F.col("_pos") + 1).alias("person"),
        F.col("_box.bbox").alias("bbox"), F.col("_box.confidence").alias("confidence"))


def detections_total(store: DataFrame) -> DataFrame:
    """One row: number of stored records."""
    return store.agg(F.count(F.lit(1)).alias("total"))


def detection_time(record_ts: Column) -> Column:
    """The record's ISO text as an instant, null when it is malformed."""
    return record_ts.try_cast("timestamp")


def people_per_window(records: DataFrame, ts: str = "ts", width: str = "10 minutes",
                      slide: str | None = None, watermark: str | None = None) -> DataFrame:
    """camera_id, window_start, window_end, frames, people, avg_people, max_people.

    `records` carries a timestamp column `ts`.  A stream needs a watermark;
    its windows are final once the watermark has passed them.
    """
    if records.isStreaming and watermark is not None:
        records = records.withWatermark(ts, watermark)
    span = F.window(ts, width, slide) if slide else F.window(ts, width)
    counted = records.groupBy(span, "camera_id").agg(
        F.count(F.lit(1)).alias("frames"),
        F.sum("person_count").alias("people"),
        F.avg("person_count").alias("avg_people"),
        F.max("person_count").alias("max_people"))
    return counted.select("camera_id", F.col("window.start").alias("window_start"),
                          F.col("window.end").alias("window_end"),
                          "frames", "people", "avg_people", "max_people")
