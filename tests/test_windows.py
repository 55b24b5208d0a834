"""Streamed windows against the batch form, in any order of files."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sparktally import catalog
from sparktally.plans import frames as f
from sparktally.streaming import windows as w

SCHEMA = "frame_id string, camera_id string, ts timestamp, person_count int"


def records(spark, n=240):
    i = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("r"), i.cast("string")).alias("frame_id"),
        F.when(i % 11 != 0, F.concat(F.lit("cam"), (i % 3).cast("string"))).alias("camera_id"),
        (F.lit("2026-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=i.cast("int"))).alias("ts"),
        F.when(i % 7 != 0, (i % 5).cast("int")).alias("person_count"))


def put(df, path, name):
    df.coalesce(1).write.mode("append").parquet(f"{path}/{name}")


def run(spark, tmp_path, **options):
    stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
              .parquet(f"{tmp_path}/in"))
    sums = w.window_sums(stream, width="1 hour", buckets=4, **({"horizon": "5 minutes"} | options))
    w.store_window_sums(sums, f"{tmp_path}/out", f"{tmp_path}/check", available_now=True).awaitTermination()
    return w.corrected_windows(spark, f"{tmp_path}/out", f"{tmp_path}/check", "1 hour")


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 2, 1, 0), (2, 0, 3, 1)])
def test_four_files_in_any_order_equal_the_batch(spark, tmp_path, order):
    data = records(spark)
    for part in order:
        put(data.where(f"cast(substr(frame_id, 2) as int) div 60 = {part}"), f"{tmp_path}/in", f"f{part}")
    got = run(spark, tmp_path)
    assert rows(got) == rows(f.people_per_window(data, width="1 hour"))
    late = w.late_records(spark, f"{tmp_path}/out").count()
    assert (late > 0) == (order != (0, 1, 2, 3))


def test_repeats_count_once_and_nothing_is_lost_over_restarts(spark, tmp_path):
    data = records(spark, 120)
    put(data.unionAll(data), f"{tmp_path}/in", "a")
    run(spark, tmp_path)
    # the second hour is still open, the first closed but remembered
    put(data.where("ts >= '2026-01-01 01:30:00'"), f"{tmp_path}/in", "b")
    put(data.where("ts < '2026-01-01 00:10:00'"), f"{tmp_path}/in", "c")
    extra = data.where("frame_id = 'r3'").withColumn("frame_id", F.lit("late"))
    put(extra, f"{tmp_path}/in", "d")
    put(extra, f"{tmp_path}/in", "e")
    got = run(spark, tmp_path)
    assert rows(got) == rows(f.people_per_window(data.unionAll(extra), width="1 hour"))
    assert [r.frame_id for r in w.late_records(spark, f"{tmp_path}/out").collect()] == ["late"]


def test_forgotten_windows_still_take_late_records(spark, tmp_path):
    data = records(spark, 240)
    put(data.where("ts >= '2026-01-01 02:00:00'"), f"{tmp_path}/in", "a")
    run(spark, tmp_path, keep="1 minute")
    put(data.where("ts < '2026-01-01 02:00:00'"), f"{tmp_path}/in", "b")
    put(data.where("ts < '2026-01-01 00:30:00'"), f"{tmp_path}/in", "c")
    assert rows(run(spark, tmp_path, keep="1 minute")) == rows(f.people_per_window(data, width="1 hour"))


def test_closed_windows_alone(spark, tmp_path):
    data = records(spark, 130)
    put(data, f"{tmp_path}/in", "a")
    run(spark, tmp_path)
    closed = w.corrected_windows(spark, f"{tmp_path}/out")
    assert rows(closed) == rows(f.people_per_window(data, width="1 hour").where("window_end <= '2026-01-01 02:00:00'"))


def test_records_without_time_camera_or_frame(spark, tmp_path):
    data = spark.createDataFrame(
        [(None, "c", 5, 1), (None, "c", 6, 2), ("x", None, 7, None), ("y", "c", None, 9)],
        "frame_id string, camera_id string, m int, person_count int").select(
        "frame_id", "camera_id", (F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(mins="m")).alias("ts"), "person_count")
    put(data, f"{tmp_path}/in", "a")
    put(data.limit(0), f"{tmp_path}/in", "b")
    assert rows(run(spark, tmp_path)) == rows(f.people_per_window(data, width="1 hour"))


def test_query_takes_four_batches_of_a_table_of_many_files(spark, tmp_path, monkeypatch):
    at = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))
    key = F.when(F.col("id") % 500 == 3, -F.col("id")).when(F.col("id") % 500 != 7, F.col("id"))
    events = spark.range(3000, numPartitions=3).select(
        key.alias("event_id"), F.when(F.col("id") % 300 != 9, at).alias("ts"), (F.col("id") % 3).alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(1.0).alias("value"),
        F.concat(F.lit('{"k": '), (F.col("id") % 101).cast("string"), F.lit("}")).alias("props"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    got = rows(catalog.people_per_window_stream(spark, str(tmp_path)))
    want = catalog.people_per_window(spark, str(tmp_path)).where("window_start is not null")
    assert got == rows(want)
    assert sum(r[3] for r in got) == 2990
    # Every batch counts, also one without records that only moves the watermark.
    assert len(list((tmp_path / "windows/checkpoint/commits").glob("[0-9]*"))) <= 5
