"""A message folder with positions: numbered segments, read as a stream by readers that each keep their own place.

A producer appends one segment per batch, named by its number; a segment is
there when its job has ended.  The position of a reader is the number of the
next segment, kept in its checkpoint as every Spark source does.  So a
reader starts at the latest segment or the earliest, and readers do not know of each other.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from sparktally.session import discard

_ROWS = pa.schema([("segment", pa.int64()), ("value", pa.string())])
#: Lines that are handed over at once.
_LINES = 10_000


def _segment(number: int) -> str:
    return f"segment={number:012d}"


def append_segment(messages: DataFrame, path: str, number: int) -> None:
    """The text column `value` as segment `number`, replaced if it is there."""
    messages.select("value").write.mode("overwrite").text(f"{path}/{_segment(number)}")


def segment_writer(path: str) -> Callable[[DataFrame, int], None]:
    """For `store_batches`: the batch id is the segment's number, so a repeated batch is the same segment."""
    return lambda batch, batch_id: append_segment(batch, path, batch_id)


class _Log:
    """The folder, through any file system that pyarrow reaches."""

    def __init__(self, path: str):
        self.files, self.root = fs.FileSystem.from_uri(path if "/" != path[:1] else f"file://{path}")

    def segments(self) -> list[int]:
        """Numbers of the segments that are whole and have no gap before them, ascending."""
        found = self.files.get_file_info(fs.FileSelector(self.root, allow_not_found=True))
        numbers = sorted(int(f.base_name.partition("=")[2]) for f in found if f.base_name.startswith("segment="))
        run: list[int] = []
        for n in numbers:
            ended = self.files.get_file_info(f"{self.root}/{_segment(n)}/_SUCCESS").type == fs.FileType.File
            if not ended or run and n != run[-1] + 1:
                break
            run.append(n)
        return run

    def parts(self, number: int) -> list[str]:
        found = self.files.get_file_info(fs.FileSelector(f"{self.root}/{_segment(number)}"))
        return sorted(f.path for f in found if f.base_name.startswith("part-") and f.size)

    def rows(self, part: _Part) -> Iterator[pa.RecordBatch]:
        with self.files.open_input_stream(part.path) as raw:
            left, ended = b"", False
            while not ended:
                block = raw.read(1 << 20)
                ended = not block
                *lines, left = (left + block).split(b"\n")
                if ended and left:
                    lines.append(left)
                for at in range(0, len(lines), _LINES):
                    some = [line.decode("utf-8", "replace") for line in lines[at:at + _LINES]]
                    yield pa.RecordBatch.from_arrays([pa.array([part.segment] * len(some), pa.int64()), pa.array(some, pa.string())],
                                                     schema=_ROWS)

    def place(self, reader: str) -> str:
        return f"{self.root}/_readers/{reader}.json"

    def positions(self) -> dict[str, int]:
        found = self.files.get_file_info(fs.FileSelector(f"{self.root}/_readers", allow_not_found=True))
        return {f.base_name.removesuffix(".json"): json.loads(self.files.open_input_stream(f.path).read())["next"]
                for f in found if f.base_name.endswith(".json")}


class _Part(InputPartition):
    def __init__(self, segment: int, path: str):
        self.segment, self.path = segment, path


class _Stream(DataSourceStreamReader):
    def __init__(self, options):
        self.log, self.reader = _Log(options["path"]), options.get("reader")
        self.start = options.get("startingOffsets", "latest")
        if self.start not in ("latest", "earliest"):
            raise ValueError(f"unknown startingOffsets {self.start!r}")

    def _end(self, run: list[int]) -> int:
        return run[-1] + 1 if run else 0

    def initialOffset(self) -> dict:
        run = self.log.segments()
        first = self._end(run) if self.start == "latest" else run[0] if run else 0
        if self.reader:
            self.commit({"next": first})
        return {"next": first}

    def latestOffset(self) -> dict:
        return {"next": self._end(self.log.segments())}

    def partitions(self, start: dict, end: dict) -> list[_Part]:
        return [_Part(n, path) for n in range(start["next"], end["next"]) for path in self.log.parts(n)]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        return self.log.rows(partition)

    def commit(self, end: dict) -> None:
        """Leave a note of what this reader needs no more, for `trim`."""
        if self.reader:
            self.log.files.create_dir(f"{self.log.root}/_readers")
            with self.log.files.open_output_stream(self.log.place(self.reader)) as out:
                out.write(json.dumps(end).encode())


class _Batch(DataSourceReader):
    def __init__(self, options):
        self.log = _Log(options["path"])

    def partitions(self) -> list[_Part]:
        return [_Part(n, path) for n in self.log.segments() for path in self.log.parts(n)]

    def read(self, partition: _Part | None) -> Iterator[pa.RecordBatch]:
        # Spark asks for one part, none, where there are no parts.
        return self.log.rows(partition) if partition is not None else iter(())


class MessageLog(DataSource):
    """Format 'message_log': option path; startingOffsets (latest, earliest) and reader (a name) for streams."""

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return "segment bigint, value string"

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options)


def read_log_stream(spark: SparkSession, path: str, starting: str = "latest", reader: str | None = None) -> DataFrame:
    """segment, value of the messages from `starting` on, or from where the query's checkpoint says."""
    spark.dataSource.register(MessageLog)
    options = {"startingOffsets": starting} | ({"reader": reader} if reader else {})
    return spark.readStream.format("message_log").options(**options).load(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """segment, value of all messages that are there."""
    spark.dataSource.register(MessageLog)
    return spark.read.format("message_log").load(path)


def trim(spark: SparkSession, path: str) -> list[int]:
    """Delete the segments that every named reader has done with; returns their numbers.

    Without a named reader nothing is deleted.  The last segment stays, as it says where
    the log ends.  A reader without a name does not hold segments back.
    """
    log = _Log(path)
    positions, run = log.positions(), log.segments()
    done = [n for n in run[:-1] if positions and n < min(positions.values())]
    for n in done:
        discard(spark, f"{path}/{_segment(n)}")
    return done
