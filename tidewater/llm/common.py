"""Helpers shared by the operators: durable tables, Arrow batches as bytes, words and their hashes in numpy."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewater.session import shared_folder

#: Bytes of text that one numpy pass holds; several arrays of eight bytes a byte exist at a time.
CHUNK = 1 << 20

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE_CODES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 & ~0x7 | 0x5)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage and survives the loss of executors.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables written by ``durable`` that no result still to be computed reads."""
    for table in tables:
        system, path = _hadoop(table.sparkSession, table.scratch_path)
        system.delete(path, True)


def scratch(spark: SparkSession) -> str:
    """The folder of this application below the shared one; it goes when the driver's JVM ends, or by ``clear``."""
    application = spark.sparkContext.applicationId
    if application not in _folders:
        _folders[application] = f"{shared_folder(spark).rstrip('/')}/tidewater-llm-{application}"
        system, path = _hadoop(spark, _folders[application])
        system.deleteOnExit(path)
    return _folders[application]


_folders: dict[str, str] = {}


def _hadoop(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def clear(spark: SparkSession) -> None:
    """Remove what the operators of this application wrote; call it when their results have been stored."""
    system, path = _hadoop(spark, scratch(spark))
    system.delete(path, True)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column and the bounds of its rows; a null row is empty."""
    wide = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(wide)
    if column.null_count:
        column = column.fill_null(b"" if wide == pa.large_binary() else "")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(bounds: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold about ``size`` bytes; a longer row comes alone."""
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1)
        yield first, last
        first = last


def spread(values: np.ndarray) -> np.ndarray:
    """Mix 64-bit values so that every bit depends on every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK * 2)
        for at, base in ((0, _BASE), (1, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[at] = np.multiply.accumulate(steps)
    return _powers


class Rolling:
    """Hashes of any substrings of one byte array, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _powers_to(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[data] * powers[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        plain = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return spread(plain + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """The words of several texts: maximal runs of bytes that ``wordly`` marks, none across texts.

    A-Z are lower-cased unless told otherwise. ``first[i]`` to ``first[i + 1]`` are the words of text ``i``; ``starts`` and ``ends`` are byte places.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, wordly: np.ndarray, lower: bool = True):
        self.data = _LOWER[data] if lower else data
        inside = wordly[self.data]
        cut = bounds[1:-1]
        cut = cut[cut < len(data)]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        before[cut] = False
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        after[cut[cut > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, bounds)
        self.hashes = Rolling(self.data).of(self.starts, self.ends)

    def text(self, first: int, last: int) -> bytes:
        """Words ``first`` to ``last`` (exclusive), joined by one space."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.starts[first:last], self.ends[first:last]))


def owners(first: np.ndarray) -> np.ndarray:
    """The text of each word, from the bounds ``first``."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def word_bytes(separators: Callable[[int], bool]) -> np.ndarray:
    return np.array([not separators(b) for b in range(256)])


#: Digits, letters and everything outside ASCII make words; the rest separates them.
ALNUM = word_bytes(lambda b: b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F)
#: Everything but white space makes words.
VISIBLE = word_bytes(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)


def combined(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` neighbours."""
    n = len(hashes) - width + 1
    total = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        # Factors without any linear relation: evenly spaced ones would give "a b b a" and "b a a b" one hash.
        for k, factor in enumerate(spread(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)):
            total += hashes[k : k + n] * factor
    return spread(total + np.uint64(width))
