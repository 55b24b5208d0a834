"""The analyses' input tables, derived from the shared star-schema test tables.

Amounts, ratings and dates are built with operations that give the same bits
in any engine: halves, whole cents and whole days.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparktally.functions.formatting import iso_utc
from sparktally.plans.frames import keep_persons

# Words left out of the sample texts (fixed list).
STOP_WORDS = [
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "with",
    "be", "as", "by", "this", "are", "at", "from", "an", "or", "de", "la", "en", "que",
    "le", "des", "et", "les", "un", "el", "der", "die", "und", "den", "von", "es", "|",
    "in the",
]

# Review scores as they are typed in, by an event's number.
SCORE_TEXTS = [None, "", "abc", "4.7", "0", "6", " 5 ", "3", "4", "5", "1e2", ".5", "99999999999", "+2"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _epoch_days_as_seconds(day) -> F.Column:
    return F.unix_date(F.to_date(day)).cast("bigint") * 86400


def ratings(spark: SparkSession, folder: str, with_user: bool = False) -> DataFrame:
    """One rating of 0.5 to 5.0 per line item; the user is the order's customer.

    Some ratings are of a movie that no table knows.
    """
    movie = F.when(F.col("l_orderkey") % 53 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey"))
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("_order"), movie.alias("movie_id"),
        (F.ceil(F.col("l_quantity") / 5) / 2.0).cast("double").alias("rating"),
        _epoch_days_as_seconds("l_shipdate").alias("ts"))
    if not with_user:
        return lines.select("movie_id", "rating", "ts")
    buyers = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("_order"), F.col("o_custkey").alias("user_id"))
    return lines.join(buyers, "_order").select("user_id", "movie_id", "rating", "ts")


def movies(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as movies; some share one title."""
    title = F.when(F.col("p_partkey") % 19 == 0, "Same Title").otherwise(F.col("p_name"))
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("movie_id"), title.alias("title"),
        F.concat_ws("|", "p_type", "p_brand").alias("genres"))


def users(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    gender = (F.when(key % 50 == 7, "x").when(key % 50 == 13, "m")
              .when(key % 2 == 0, "M").otherwise("F"))
    return table(spark, folder, "customer").select(
        key.alias("user_id"), gender.alias("gender"), (key % 60 + 10).cast("int").alias("age"),
        F.col("c_nationkey").alias("occupation_id"))


def occupations(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("occupation_id"), F.col("n_name").alias("occupation"))


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as reviews, some without an id; the label gives the sentiment, null without one."""
    labels = table(spark, folder, "labels")
    sentiment = (F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive")
                 .when(F.col("quality") == 0, "neutral"))
    return (table(spark, folder, "documents").join(labels, "doc_id", "left")
            .select(_review_id(), F.col("text").alias("review"),
                    F.col("source").alias("category"), F.col("lang").alias("aspect"),
                    sentiment.alias("sentiment")))


def _review_id():
    return F.when(F.col("doc_id") % 31 != 0, F.col("doc_id")).alias("id")


def reviews_unlabelled(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews without the sentiment, where an analysis does not look at it."""
    return table(spark, folder, "documents").select(
        _review_id(), F.col("text").alias("review"),
        F.col("source").alias("category"), F.col("lang").alias("aspect"))


def orders(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    handed_over = F.col("o_orderdate") + F.make_dt_interval(days=(key % 120).cast("int"))
    return table(spark, folder, "orders").select(
        key.alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("purchase_ts"),
        F.when(key % 37 != 0, handed_over).alias("carrier_ts"))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their country, some without one."""
    nations = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    return (table(spark, folder, "customer").join(nations, "c_nationkey", "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    F.when(F.col("c_custkey") % 41 != 0, F.col("country")).alias("country")))


def items(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"), price.alias("price"),
        (F.floor(price * F.col("l_tax") * 100.0) / 100.0).alias("freight"),
        F.col("l_shipdate").alias("shipping_limit"))


def products(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        key.alias("product_id"), F.when(key % 29 != 0, F.col("p_type")).alias("category"))


def _event_number():
    return F.regexp_extract("props", r'"k": *(\d+)', 1).cast("int")


def order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Two events per order; a fixed share of the score texts is dirty."""
    texts = F.array(*[F.lit(text).cast("string") for text in SCORE_TEXTS])
    score = F.element_at(texts, F.col("_k") % len(SCORE_TEXTS) + 1)
    return (table(spark, folder, "events").select("event_id", _event_number().alias("_k"))
            .select(F.expr("event_id div 2").alias("order_id"), score.alias("score")))


def detection_records(events: DataFrame) -> DataFrame:
    """Events as detection records; works on a stream too.  `ts` is an instant."""
    k = F.col("_k")
    boxes = F.transform(
        F.filter(F.sequence(F.lit(1), F.lit(4)), lambda i: i <= k % 5),
        lambda i: F.struct(
            F.array((i * 10).cast("double"), (i * 5).cast("double"),
                    (i * 10 + k).cast("double"), (i * 5 + k).cast("double")).alias("bbox"),
            (((k * i * 7) % 101) / 100.0).cast("double").alias("confidence"),
            F.when((k + i) % 3 == 0, "car").otherwise("person").alias("class")))
    ts = F.col("ts").cast("timestamp")
    return (events.select("event_id", ts.alias("ts"), "user_id", _event_number().alias("_k"))
            .select(F.col("event_id").cast("string").alias("frame_id"),
                    F.concat(F.lit("cam"), F.col("user_id").cast("string")).alias("camera_id"),
                    "ts", iso_utc(F.col("ts")).alias("timestamp"),
                    keep_persons(boxes).alias("detections"))
            .withColumn("person_count", F.size("detections")))


def detections(spark: SparkSession, folder: str) -> DataFrame:
    return detection_records(table(spark, folder, "events"))


def detection_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The events as a stream, `max_files` a batch if given; the table is one file or a folder of files."""
    name = "events.parquet"
    batch = table(spark, folder, "events")
    reader = spark.readStream.schema(batch.schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    first = batch.select("_metadata.file_name").first()
    if first is not None and first.file_name == name:
        return detection_records(reader.option("pathGlobFilter", name).parquet(folder))
    return detection_records(reader.parquet(f"{folder}/{name}"))


def frames(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as image files: the columns of a binary file listing."""
    key = F.col("page_id")
    suffix = F.when(key % 3 == 0, ".JPG").when(key % 3 == 1, ".jpeg").otherwise(".png")
    content = F.encode("html", "UTF-8")
    return table(spark, folder, "pages").select(
        F.concat(F.lit("/frames/"), key.cast("string"), suffix).alias("path"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("modificationTime"),
        F.octet_length("html").cast("bigint").alias("length"),
        content.alias("content"))


def _drawn(pages):
    """Per page a grey PNG with up to four bright rectangles; what is drawn follows from the page's length."""
    def part(name: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    for batch in pages:
        images = []
        for n in batch.column(1).to_pylist():
            rows = np.zeros((32, 65), np.uint8)  # the first byte of a row says that it is stored as it is
            for i in range(1, n % 5 + 1):
                x = 16 * i - 14
                rows[1:4 + (n * 7 + i * 5) % 27, x:x + 3 + n * i % 11] = 40 + (n * 7 + i * 13) % 216
            images.append(b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", 64, 32, 8, 0, 0, 0, 0))
                          + part(b"IDAT", zlib.compress(rows.tobytes())) + part(b"IEND", b""))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(images, pa.binary())], names=["page_id", "image"])


def raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Raw-frame messages, one image per page; of ten, one each is no base64, cut short, no image, or damaged."""
    pages = table(spark, folder, "pages")
    images = pages.select("page_id", F.octet_length("html")).mapInArrow(_drawn, "page_id long, image binary")
    # Only pages whose own text is sent have their text looked up.
    texts = pages.where("page_id % 10 = 7").select("page_id", F.encode("html", "UTF-8").alias("text"))
    key, image = F.col("page_id"), F.col("image")
    # Another byte in the pixel data, at a place where no chunk begins.
    other = 255 - F.conv(F.hex(F.substring(image, F.lit(50), F.lit(1))), 16, 10).cast("int")
    damaged = F.concat(F.substring(image, F.lit(1), F.lit(49)), F.unhex(F.lpad(F.hex(other), 2, "0")),
                       F.substring(image, F.lit(51), F.octet_length(image)))
    payload = (F.when(key % 10 == 5, F.substring(image, F.lit(1), F.octet_length(image) - 9))
               .when(key % 10 == 7, F.col("text")).when(key % 10 == 9, damaged).otherwise(image))
    encoded = F.translate(F.base64(payload), "\r\n", "")
    return images.join(texts, "page_id", "left").select(
        key.cast("string").alias("frame_id"),
        F.concat(F.lit("cam"), (key % 4).cast("string")).alias("camera_id"),
        F.lit("2024-01-01T00:00:00+00:00").alias("timestamp"),
        F.lit("png").alias("image_format"),
        F.when(key % 10 == 3, "%%%").otherwise(encoded).alias("image_data"))
