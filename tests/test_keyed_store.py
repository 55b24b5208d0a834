"""One record per key, after replays, repeats, failures and rewriting."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sparktally.sources import sample_tables
from sparktally.streaming import pipeline as p
from sparktally.streaming.keyed_store import KeyedStore

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("frame_id", T.StringType()), T.StructField("timestamp", T.StringType()),
                       T.StructField("n", T.IntegerType())])


def some(spark, first, last, start="2026-01-01T00:00:00+00:00"):
    at = F.lit(start).cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))
    return spark.range(first, last).select(
        F.concat(F.lit("f"), F.col("id").cast("string")).alias("frame_id"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("timestamp"), F.col("id").cast("int").alias("n"))


def test_repeats_leave_one_record(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path), SCHEMA)
    assert store.read().count() == 0 and store.last_commit() == 0
    assert store.merge(some(spark, 0, 60)) == 60
    assert store.merge(some(spark, 0, 60)) == 0 and store.last_commit() == 1
    again = some(spark, 40, 80)
    assert store.merge(again.unionAll(again)) == 20
    assert rows(store.read()) == rows(some(spark, 0, 80))
    # a repeat that differs: the one stored first stays
    assert store.merge(some(spark, 0, 1).withColumn("n", F.lit(99))) == 0
    assert store.read("2026-01-02", "2026-01-02").count() == 24
    assert store.read(commit=1).count() == 60


def test_records_without_key_or_time(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path), SCHEMA)
    odd = spark.createDataFrame([(None, "2026-01-01T00:00:00Z", 1), (None, "2026-01-01T00:00:00Z", 1),
                                 (None, "2026-01-01T00:00:00Z", 2), ("a", "no time", 1), ("a", None, 1), (None, None, None)], SCHEMA)
    assert store.merge(odd) == 4
    assert store.merge(odd) == 0
    assert rows(store.read())[-1] == (None, None, None)
    assert store.merge(odd.limit(0)) == 0


def test_a_merge_that_dies_leaves_nothing(spark, tmp_path, monkeypatch):
    store = KeyedStore(spark, str(tmp_path), SCHEMA)
    store.merge(some(spark, 0, 10))
    with monkeypatch.context() as broken:
        def die(*_):
            raise RuntimeError("lost")
        broken.setattr(store, "_commit", die)
        with pytest.raises(RuntimeError):
            store.merge(some(spark, 5, 30))
    assert rows(store.read()) == rows(some(spark, 0, 10))
    assert store.merge(some(spark, 5, 20)) == 10  # other rows than those left behind
    assert rows(store.read()) == rows(some(spark, 0, 20))


def test_days_of_many_folders_are_written_anew(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path), SCHEMA, most_folders=3)
    for i in range(7):
        store.merge(some(spark, i, i + 2))
        assert rows(store.read()) == rows(some(spark, 0, i + 2))
    assert max(len(n) for n in store._folders(store.last_commit()).values()) <= 3
    before = rows(store.read())
    store.vacuum(keep=1)
    assert rows(store.read()) == before and store._commits().select("commit").distinct().count() == 1
    store.merge(some(spark, 100, 101))
    assert store.read().count() == len(before) + 1


def test_only_days_of_the_batch_are_read(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path), SCHEMA)
    store.merge(some(spark, 0, 240))
    files = store._read({d: n for d, n in store._folders(1).items() if d == "2026-01-03"}).inputFiles()
    assert files and all("day=2026-01-03" in f for f in files)


def test_stream_replayed_from_the_start(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    records = sample_tables.detection_stream(spark, folder)
    batch = sample_tables.detections(spark, folder)
    store = KeyedStore(spark, str(tmp_path / "store"), T.StructType([f for f in batch.schema if f.name not in ("ts", "event_id")]))
    for check in ("one", "one", "two"):  # a restart, and a lost checkpoint
        p.store_batches(records, store.writer(), str(tmp_path / check), available_now=True).awaitTermination()
    assert rows(store.read()) == rows(batch.select(*store.schema.fieldNames()))
