"""A folder of text files that grow, read as a stream: every complete line once, so many bytes at a time.

    spark.dataSource.register(GrowingFolder)
    spark.readStream.format("growing_folder").option("log", "/shared/state/in").option("bytesPerTrigger", "1g").load("/shared/in")

Each micro-batch continues every file from the byte it had reached: appended lines are read once, and so are files that turn up
late, whatever their modification time. What a micro-batch reads is written to ``log`` before it is planned, as ranges of bytes that begin
and end at line ends; the offset is the number of the log entry. The log belongs to the stream's checkpoint. Paths are those of
``pyarrow.fs``: local or shared folders, ``hdfs://``, ``s3://`` and others.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

_BLOCK = 1 << 16
_ROWS = 10_000
_UNITS = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}


def _bytes(text: str) -> int:
    text = text.strip().lower()
    return int(text[:-1]) * _UNITS[text[-1]] if text[-1] in _UNITS else int(text)


def _open_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class Range(InputPartition):
    def __init__(self, name: str, begin: int, end: int):
        self.name, self.begin, self.end = name, begin, end


class GrowingFolder(DataSource):
    """``value, file, at``: a line without its end, the file's name and the byte at which the line begins.

    Options: ``log`` (required), ``bytesPerTrigger`` (256m; a longer line comes whole), ``splitBytes`` (32m, what one task reads). A line
    without an end waits until it is complete. A file that became shorter stops the stream with an error.
    """

    @classmethod
    def name(cls) -> str:
        return "growing_folder"

    def schema(self) -> str:
        return "value string, file string, at bigint"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _GrowingStream(
            self.options["path"], self.options["log"], _bytes(self.options.get("bytesPerTrigger", "256m")), _bytes(self.options.get("splitBytes", "32m"))
        )


class _GrowingStream(DataSourceStreamReader):
    def __init__(self, folder: str, log: str, budget: int, split: int):
        self.folder, self.log, self.budget, self.split = folder, log, budget, split
        self.reached: dict[str, int] | None = None
        self.entries = 0

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def latestOffset(self) -> dict:
        self._recover()
        ranges = self._next_ranges()
        if ranges:
            self._write(self.entries + 1, ranges)
            self.entries += 1
            self.reached.update({name: end for name, _, end in ranges})
        return {"entry": self.entries}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        ranges = [r for n in range(start["entry"] + 1, end["entry"] + 1) for r in self._read(n)["ranges"]]
        return [Range(name, at, min(at + self.split, stop)) for name, begin, stop in ranges for at in range(begin, stop, self.split)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        system, folder = _open_system(self.folder)
        with io.BufferedReader(system.open_input_file(f"{folder}/{partition.name}"), _BLOCK) as file:
            at = partition.begin
            if at:  # a line that goes across the border belongs to the range before
                file.seek(at - 1)
                at += len(file.readline()) - 1
            lines, places = [], []
            while at < partition.end:
                line = file.readline()
                lines.append(line.removesuffix(b"\n").removesuffix(b"\r").decode())
                places.append(at)
                at += len(line)
                if len(lines) == _ROWS:
                    yield self._batch(lines, places, partition.name)
                    lines, places = [], []
            if lines:
                yield self._batch(lines, places, partition.name)

    @staticmethod
    def _batch(lines: list[str], places: list[int], name: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(lines), pa.array([name] * len(lines)), pa.array(places, pa.int64())], ["value", "file", "at"])

    def _recover(self) -> None:
        """What the log says about every file, once a start: entries follow one another from the last one that holds a summary."""
        if self.reached is not None:
            return
        system, log = _open_system(self.log)
        system.create_dir(log)
        names = [f.base_name for f in system.get_file_info(fs.FileSelector(log))]
        numbers = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")
        self.entries, self.reached, tail = (numbers[-1] if numbers else 0), {}, []
        for number in reversed(numbers):
            entry = self._read(number)
            tail.append(entry["ranges"])
            if "before" in entry:
                self.reached = dict(entry["before"])
                break
        for ranges in reversed(tail):
            self.reached.update({name: end for name, _, end in ranges})

    def _next_ranges(self) -> list[list]:
        system, folder = _open_system(self.folder)
        files = [f for f in system.get_file_info(fs.FileSelector(folder)) if f.is_file and f.base_name[0] not in "._"]
        left, out = self.budget, []
        for file in sorted(files, key=lambda f: (f.mtime_ns or 0, f.base_name)):
            begin = self.reached.get(file.base_name, 0)
            if file.size < begin:
                raise ValueError(f"{file.base_name} in {self.folder} became shorter than the {begin} bytes read of it")
            if left <= 0 or file.size == begin:
                continue
            end = self._line_end(system, file.path, begin, min(begin + left, file.size), file.size if not out else 0)
            if end > begin:
                out.append([file.base_name, begin, end])
                left -= end - begin
        return out

    @staticmethod
    def _line_end(system: fs.FileSystem, path: str, begin: int, goal: int, size: int) -> int:
        """Behind the last line end up to ``goal``, or else behind the first one after it and before ``size``; ``begin`` if there is none."""
        with system.open_input_file(path) as file:
            stop = goal
            while stop > begin:
                first = max(begin, stop - _BLOCK)
                found = file.read_at(stop - first, first).rfind(b"\n")
                if found >= 0:
                    return first + found + 1
                stop = first
            while goal < size:
                block = file.read_at(min(_BLOCK, size - goal), goal)
                if (found := block.find(b"\n")) >= 0:
                    return goal + found + 1
                goal += len(block)
        return begin

    def _read(self, number: int) -> dict:
        system, log = _open_system(self.log)
        with system.open_input_stream(f"{log}/{number}.json") as file:
            return json.loads(file.read())

    def _write(self, number: int, ranges: list[list]) -> None:
        """One file a micro-batch, moved into place when it is complete; every hundredth begins with a summary of all before it."""
        system, log = _open_system(self.log)
        entry = {"ranges": ranges} | ({"before": self.reached} if number % 100 == 0 else {})
        with system.open_output_stream(f"{log}/.{number}.json.part") as file:
            file.write(json.dumps(entry).encode())
        system.move(f"{log}/.{number}.json.part", f"{log}/{number}.json")

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass
