"""Logs that grow: a stream of the lines appended to files.

Spark's own file stream reads a file once and never sees what is appended to it. This
source keeps a byte offset per file. An offset always lies behind a line end, so a line
that is still being written waits for the next batch, and a restart goes on where the
checkpoint stands. New bytes are cut into splits of a bounded size, each read on its own; a
split owns the lines that start in it. A task takes several splits if there are many.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from meterfold.sources import messages

NAME = "growing_log"
SPLIT_BYTES = 64 << 20
#: A batch of more splits than this many has so many tasks, or more where each would get over TASK_BYTES.
TASKS, TASK_BYTES = 64, 64 << 20
_SCHEMA = "file string, position bigint, value string"
_LOOK_BACK = 1 << 16


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if ":" in path.split("/")[0]:
        return fs.FileSystem.from_uri(path if "://" in path else path.replace(":", "://", 1))
    return fs.LocalFileSystem(), path


@dataclass
class Run:
    """Bytes of one file, cut into splits from ``low`` on; ``whole`` if they begin with a line."""

    name: str
    low: int
    high: int
    whole: bool


@dataclass
class Share(InputPartition):
    """What one task reads."""

    runs: list[Run]


class LogReader(DataSourceStreamReader):
    def __init__(self, path: str, split_bytes: int):
        self._path, self._split = path, split_bytes

    def _sizes(self) -> dict[str, int]:
        system, path = _opened(self._path)
        found = system.get_file_info(path)
        if found.type == fs.FileType.Directory:
            files = system.get_file_info(fs.FileSelector(path))
        else:
            files = [found]
        return {
            f.path: f.size for f in files if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))
        }

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Behind the last line end of every file."""
        system, _ = _opened(self._path)
        found = {}
        for name, size in sorted(self._sizes().items()):
            with system.open_input_file(name) as file:
                high, end = size, 0
                while high and not end:
                    low = max(0, high - _LOOK_BACK)
                    cut = file.read_at(high - low, low).rfind(b"\n")
                    high, end = low, low + cut + 1 if cut >= 0 else 0
            found[name] = end
        return found

    def partitions(self, start: dict, end: dict) -> list[Share]:
        new = []
        for name, high in end.items():
            low = start.get(name, 0)
            if high < low:
                raise ValueError(f"{name} has become shorter; a growing log only gets longer")
            new.append((name, low, high))
        most = min(sum(high - low for _, low, high in new) // TASKS, TASK_BYTES)
        shares, room = [], 0
        for name, low, high in new:
            at = low
            while at < high:
                if room <= 0:
                    shares.append(Share([]))
                    room = max(most, 1)
                # Whole splits, up to the one that fills the share.
                to = min(at + -(-room // self._split) * self._split, high)
                shares[-1].runs.append(Run(name, at, to, at == low))
                room -= to - at
                at = to
        return shares

    def read(self, share: Share) -> Iterator[pa.RecordBatch]:
        system, _ = _opened(self._path)
        for run in share.runs:
            with system.open_input_file(run.name) as file:
                for low in range(run.low, run.high, self._split):
                    whole = run.whole and low == run.low
                    yield from self._lines(file, run.name, low, min(low + self._split, run.high), whole)

    def _lines(self, file: pa.NativeFile, name: str, start: int, high: int, whole: bool) -> Iterator[pa.RecordBatch]:
        """The lines that start in one split."""
        low = start if whole else start - 1
        data = file.read_at(high - low, low)
        if not whole:
            skip = data.find(b"\n") + 1
            if not skip or low + skip >= high:
                return
            low, data = low + skip, data[skip:]
        while data and not data.endswith(b"\n"):
            more = file.read_at(_LOOK_BACK, low + len(data))
            if not more:
                raise ValueError(f"{name} ends inside a line that was whole before")
            cut = more.find(b"\n") + 1
            data += more[:cut] if cut else more
        ends = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 0x0A)
        positions = low + np.append(0, ends[:-1] + 1)[: len(ends)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.repeat(pa.scalar(name, pa.string()), len(ends)),
                pa.array(positions, pa.int64()),
                pa.array(data.decode("utf-8", "replace").split("\n")[:-1], pa.string()),
            ],
            names=["file", "position", "value"],
        )

    def commit(self, end: dict) -> None:
        pass


class GrowingLog(DataSource):
    """``spark.readStream.format("growing_log").load(path)``: a file, or the files of a folder.

    ``path`` is on a file system that ``pyarrow.fs`` opens on every machine. The option
    ``splitBytes`` bounds what one task holds at once. Files may be added and may grow; one that
    becomes shorter is an error. Lines end with a line feed and are UTF-8.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return _SCHEMA

    def streamReader(self, schema: StructType) -> LogReader:
        return LogReader(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))


def stream_lines(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``file``, ``position`` and ``value`` of every line that is, or will be, appended."""
    spark.dataSource.register(GrowingLog)
    return spark.readStream.format(NAME).option("splitBytes", split_bytes).load(path)


def stream_envelopes(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A growing envelope log as a stream of (topic, key, value) rows, parsed strictly."""
    return messages.parse_envelopes(stream_lines(spark, path, split_bytes), "value")
