"""A custom source that reads a folder of record files, one task per file, as a table or as a stream.

    spark.dataSource.register(SensorFolder)
    spark.readStream.format("sensor_folder").load("/shared/sensors")

A stream reads files in order of their modification time, then name; its offset is the last file read and the number
of files up to it. A file that turns up behind the offset (moved there with an old modification time) stops the
stream with an error instead of being lost. Files are complete when they appear; for files that grow, late files and a
bound of what a micro-batch reads use ``GrowingFolder``. Large files are cut at line ends into splits of ``splitBytes`` (32 MB).
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

SPLIT_BYTES = 32 * 1024 * 1024
_ROWS = 10_000


class FilePartition(InputPartition):
    def __init__(self, path: str, begin: int, end: int):
        self.path, self.begin, self.end = path, begin, end


def _files(folder: str) -> list[tuple[int, str]]:
    """(modification time in ns, name), in the order of reading."""
    with os.scandir(folder) as entries:
        return sorted((e.stat().st_mtime_ns, e.name) for e in entries if e.is_file() and not e.name.startswith((".", "_")))


def _splits(folder: str, names: list[str], size: int) -> list[FilePartition]:
    out = []
    for name in names:
        path = os.path.join(folder, name)
        length = os.path.getsize(path)
        out += [FilePartition(path, at, min(at + size, length)) for at in range(0, length, size)]
    return out


def _lines(partition: FilePartition) -> Iterator[str]:
    """The lines that begin inside the split."""
    with open(partition.path, "rb") as file:
        if partition.begin:
            file.seek(partition.begin - 1)
            file.readline()
        while file.tell() < partition.end:
            yield file.readline().decode().rstrip("\n")


def _sensor_rows(partition: FilePartition) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", pa.string()), ("ts", pa.int64()), ("vc", pa.float64())])
    rows: list[tuple[str, int, float]] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for line in _lines(partition):
        name, ts, vc = line.split(",")[:3]
        rows.append((name, int(ts), float(vc)))
        if len(rows) == _ROWS:
            yield batch()
            rows.clear()
    if rows:
        yield batch()


class SensorFolder(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sensor_folder"

    def schema(self) -> str:
        return "id string, ts bigint, vc double"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _FolderReader(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _FolderStream(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))


class _FolderReader(DataSourceReader):
    def __init__(self, folder: str, size: int):
        self.folder, self.size = folder, size

    def partitions(self) -> list[FilePartition]:
        return _splits(self.folder, [name for _, name in _files(self.folder)], self.size)

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        return _sensor_rows(partition)


class _FolderStream(DataSourceStreamReader):
    def __init__(self, folder: str, size: int):
        self.folder, self.size = folder, size

    def initialOffset(self) -> dict:
        return {"time": 0, "file": "", "count": 0}

    def latestOffset(self) -> dict:
        files = _files(self.folder)
        time, name = files[-1] if files else (0, "")
        return {"time": time, "file": name, "count": len(files)}

    def partitions(self, start: dict, end: dict) -> list[FilePartition]:
        first, last = (start["time"], start["file"]), (end["time"], end["file"])
        files = _files(self.folder)
        behind = sum(f <= first for f in files)
        if behind > start["count"]:
            raise ValueError(f"{behind - start['count']} files arrived in {self.folder} behind the last file read, {start['file']}")
        return _splits(self.folder, [f[1] for f in files if first < f <= last], self.size)

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        return _sensor_rows(partition)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass
