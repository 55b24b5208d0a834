"""Positions of readers: start, restart, trimming."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sparktally.sources import message_log as m
from sparktally.streaming import pipeline as p


def put(spark, path, number, values):
    m.append_segment(spark.createDataFrame([(v,) for v in values], "value string").repartition(2), path, number)


@pytest.fixture
def log(spark, tmp_path):
    path = str(tmp_path / "log")

    def run(name, starting="earliest"):
        stream = m.read_log_stream(spark, path, starting, reader=name)
        p.store_detections(stream, f"{tmp_path}/{name}", f"{tmp_path}/{name}-check", available_now=True).awaitTermination()
        try:
            return sorted(r.value for r in spark.read.schema("segment bigint, value string").parquet(f"{tmp_path}/{name}").collect())
        except Exception:
            return []

    return path, run


def test_two_readers_keep_their_own_place(spark, log):
    path, run = log
    put(spark, path, 0, ["a", "b", "ü \U0001f600", ""])
    assert run("all") == ["", "a", "b", "ü \U0001f600"]
    assert run("new", "latest") == []
    put(spark, path, 1, ["c"])
    put(spark, path, 2, ["d", "c"])
    assert run("new", "latest") == ["c", "c", "d"]
    assert run("all") == ["", "a", "b", "c", "c", "d", "ü \U0001f600"]
    for name, count in (("all", 7), ("new", 3)):  # nothing new, nothing again
        assert len(run(name, "latest")) == count
    assert rows(m.read_log(spark, path).select("segment").distinct()) == [(0,), (1,), (2,)]


def test_unfinished_segments_and_gaps_wait(spark, log, tmp_path):
    path, run = log
    put(spark, path, 0, ["a"])
    put(spark, path, 1, ["b"])
    put(spark, path, 3, ["d"])
    done = tmp_path / "log" / "segment=000000000001" / "_SUCCESS"
    done.unlink()
    assert run("r") == ["a"]
    done.write_text("")
    assert run("r") == ["a", "b"]
    put(spark, path, 2, ["c"])
    assert run("r") == ["a", "b", "c", "d"]


def test_trimmed_by_the_slowest_reader(spark, log):
    path, run = log
    for n in range(4):
        put(spark, path, n, [f"v{n}"])
        run("fast")
        if n < 2:
            run("slow")
    gone = m.trim(spark, path)
    assert gone and max(gone) < 2 and m._Log(path).segments() == list(range(max(gone) + 1, 4))
    assert run("slow") == ["v0", "v1", "v2", "v3"] == run("fast")
    put(spark, path, 4, ["v4"])
    assert run("slow")[-1] == "v4" and run("late", "earliest")[0] == f"v{max(gone) + 1}"


def test_listing_stays_bounded(spark, log):
    path, _ = log
    for n in range(300):  # segments as their files lie, without a job each
        folder = f"{path}/{m._segment(n)}"
        fs = m._Log(path).files
        fs.create_dir(folder)
        for name, data in (("part-0", b"x\n"), ("_SUCCESS", b"")):
            with fs.open_output_stream(f"{folder}/{name}") as out:
                out.write(data)
        if n % 10 == 9:
            m._Stream({"path": path, "reader": "r"}).commit({"next": n})
            m.trim(spark, path)
            assert len(m._Log(path).segments()) <= 2
    assert m.read_log(spark, path).count() == 1


def test_batches_of_a_producer_are_segments(spark, log, tmp_path):
    path, run = log
    source = tmp_path / "in"
    for n in range(3):
        spark.createDataFrame([(f"line {n}",)], "value string").write.mode("append").text(str(source))
        p.store_batches(spark.readStream.text(str(source)), m.segment_writer(path), str(tmp_path / "check"),
                        available_now=True).awaitTermination()
    assert run("r") == ["line 0", "line 1", "line 2"] and m._Log(path).segments() == [0, 1, 2]


def test_nothing_there_and_wrong_start(spark, log):
    path, run = log
    assert m.read_log(spark, path).count() == 0 and run("r") == [] and m.trim(spark, path) == []
    with pytest.raises(Exception, match="startingOffsets"):
        run("x", "sometime")
