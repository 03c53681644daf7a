"""Benchmark decontamination: Wu-Manber search of benchmark windows in documents.

Patterns are windows of benchmark words. A table of shifts, addressed by the hash of a block of words, tells how far the
search may jump; where it says 0, the hash of the last block selects a bucket of patterns, and comparing the words
decides. Many stretches of text walk side by side in numpy.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import ALNUM, CHUNK, Words, byte_column, chunks, combined, durable, map_batches, owners

WINDOW = 10
BLOCK = 3
#: Windows of the tables of one pass, and their bytes: what a pass may broadcast. A window that is longer alone forms a table.
TABLE_WINDOWS = 500_000
TABLE_BYTES = 1 << 26
SHIFT_BITS = 20
#: Words of a stretch; all stretches of a chunk walk at once.
STRETCH = 256


class PatternTable:
    """Wu-Manber tables for windows of one length: pattern ``k`` is window ``k``, of the item named ``names[items[k]]``."""

    def __init__(self, length: int, windows: pa.Array, items: list[str]):
        self.length = length
        self.block = min(BLOCK, length)
        self.jump = length - self.block + 1
        data, self.bounds = byte_column(windows)
        self.data = data.tobytes()
        self.names, self.items = np.unique(np.array(items, object), return_inverse=True)
        rows = np.concatenate([Words(data[self.bounds[a] : self.bounds[z]], self.bounds[a : z + 1] - self.bounds[a], ALNUM).hashes for a, z in chunks(self.bounds)])
        rows = rows.reshape(-1, length)
        self.shifts = np.full(1 << SHIFT_BITS, self.jump, np.int8)
        for end in range(self.block, length + 1):
            blocks = self._blocks(rows[:, end - self.block : end])
            np.minimum.at(self.shifts, self._slot(blocks), np.int8(length - end))
        suffix = self._blocks(rows[:, length - self.block :])
        self.order = np.argsort(suffix, kind="stable")
        self.suffixes = suffix[self.order]

    def _blocks(self, rows: np.ndarray) -> np.ndarray:
        return combined(rows.ravel(), self.block)[:: self.block]

    def item(self, k: int) -> str:
        return self.names[self.items[k]]

    @staticmethod
    def _slot(blocks: np.ndarray) -> np.ndarray:
        return (blocks >> np.uint64(64 - SHIFT_BITS)).astype(np.int64)

    def places(self, words: Words) -> Iterator[tuple[int, int]]:
        """(first word, pattern) of every occurrence."""
        counts = np.diff(words.first)
        blocks = combined(words.hashes, self.block)
        if not len(blocks):
            return
        usable = np.maximum(counts - self.length + 1, 0)
        pieces = -(-usable // STRETCH)
        text = np.repeat(np.arange(len(counts)), pieces)
        number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = words.first[text] + number * STRETCH
        stop = np.minimum(at + STRETCH, words.first[text] + usable[text])
        found = []
        while len(at):
            last = at + (self.length - self.block)
            shift = self.shifts[self._slot(blocks[last])]
            found.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        hits = np.concatenate(found) if found else np.zeros(0, np.int64)
        tail = blocks[hits + (self.length - self.block)]
        left = np.searchsorted(self.suffixes, tail, "left")
        right = np.searchsorted(self.suffixes, tail, "right")
        for where in np.flatnonzero(right > left):
            first = int(hits[where])
            piece = words.text(first, first + self.length)
            for k in self.order[left[where] : right[where]]:
                if self.data[self.bounds[k] : self.bounds[k + 1]] == piece:
                    yield first, int(k)


def _windows(batches):
    """The windows of every item, at most 65 536 or a chunk of bytes to a batch."""
    for batch in batches:
        items = batch.column(0).to_pylist()
        data, bounds = byte_column(batch.column(1))
        for k, item in enumerate(items):
            words = Words(data[bounds[k] : bounds[k + 1]], bounds[k : k + 2] - bounds[k], ALNUM)
            n = len(words.starts)
            length = min(WINDOW, n)
            found, size = [], 0
            for first in range(n - length + 1 if n else 0):
                found.append(words.text(first, first + length))
                size += len(found[-1])
                if len(found) == 1 << 16 or size >= CHUNK:
                    yield _window_batch(item, length, found)
                    found, size = [], 0
            if found:
                yield _window_batch(item, length, found)


def _window_batch(item: str, length: int, found: list[bytes]) -> pa.RecordBatch:
    columns = [pa.array([item] * len(found)), pa.array([length] * len(found), pa.int32()), pa.array(found, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["item", "length", "piece"])


def _tables(rows: pd.DataFrame) -> pd.DataFrame:
    """Tables over the windows of a group, cut where a bound of a pass is reached."""
    rows = rows.sort_values(["length", "piece", "item"])
    sizes = rows["piece"].map(len).to_numpy()
    cuts, count, size = [0], 0, 0
    for k, n in enumerate(sizes.tolist()):
        if count and (count == TABLE_WINDOWS or size + n > TABLE_BYTES):
            cuts.append(k)
            count, size = 0, 0
        count, size = count + 1, size + n
    out = []
    for a, z in zip(cuts, [*cuts[1:], len(rows)]):
        parts = rows.iloc[a:z].groupby("length")
        out.append(pickle.dumps([PatternTable(int(n), pa.array(part["piece"], pa.large_binary()), part["item"].tolist()) for n, part in parts]))
    return pd.DataFrame({"tables": out})


def mark_hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``n_items``, ``item_list`` and ``spans`` (word ranges of the hits) added.

    ``n_items`` and ``item_list`` (text ids in string order) count items once each; a null item id is no item. Texts
    that are null or empty have no words. Equal rows are judged alike, row by row. Input columns with one of the added
    names are replaced. An empty benchmark hits nothing.

    Items and texts of any length are read whole. Different windows of items are hashed into groups of about ``TABLE_WINDOWS``; a task
    builds the tables of a group, cut at ``TABLE_WINDOWS`` windows or ``TABLE_BYTES``. Each cut is one pass over the documents and
    the only thing broadcast, so a very long item takes several passes.
    """
    docs = docs.drop("n_words", "n_hit", "n_items", "item_list", "spans")
    added = (
        T.StructType()
        .add("n_words", T.LongType())
        .add("spans", T.ArrayType(T.StructType().add("first", T.LongType()).add("last", T.LongType())))
        .add("found_items", T.ArrayType(T.StringType()))
    )
    out, first_pass = docs, True
    for tables in _groups(benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text"))):
        if not first_pass:
            out = durable(out, "decontamination")
        shared = docs.sparkSession.sparkContext.broadcast(tables)
        out = map_batches(out, _searcher(shared, text, first_pass), T.StructType(docs.schema.fields + added.fields))
        first_pass = False
    return out.select(
        *(F.col(f"`{c}`") for c in docs.columns),
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"]).alias("n_hit"),
        F.size("found_items").cast("long").alias("n_items"),
        F.array_join("found_items", ",").alias("item_list"),
        "spans",
    )


def _groups(benchmark: DataFrame) -> Iterator[list[PatternTable]]:
    """Pattern tables of bounded size; the driver holds those of one pass. One pass without tables if there is no window."""
    texts = benchmark.where(F.col("item").isNotNull()).select(F.col("item").cast("string").alias("item"), "text")
    windows = durable(texts.mapInArrow(_windows, "item string, length int, piece binary").distinct(), "benchmark-windows")
    total, size = windows.agg(F.count("*"), F.sum(F.length("piece"))).first()
    groups = max(1, -(-total // TABLE_WINDOWS), -(-(size or 0) // TABLE_BYTES))
    placed = windows.withColumn("number", F.pmod(F.xxhash64("piece", "item"), F.lit(groups)))
    built = durable(placed.groupBy("number").applyInPandas(_tables, "tables binary"), "pattern-tables")
    for row in built.toLocalIterator():
        yield pickle.loads(row["tables"])
    if not total:
        yield []


def _searcher(shared, text: str, first_pass: bool):
    def search(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, bounds = byte_column(batch.column(batch.schema.get_field_index(text)))
        rows = batch.num_rows
        counts = np.zeros(rows, np.int64)
        hit: list[list[dict]] = [[] for _ in range(rows)]
        items: list[set[str]] = [set() for _ in range(rows)]
        for a, z in chunks(bounds):
            words = Words(data[bounds[a] : bounds[z]], bounds[a : z + 1] - bounds[a], ALNUM)
            counts[a:z] = np.diff(words.first)
            owner = owners(words.first)
            marks: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for table in shared.value:
                for first, k in table.places(words):
                    doc = int(owner[first])
                    items[a + doc].add(table.item(k))
                    begin = first - int(words.first[doc])
                    marks[doc].append((begin, begin + table.length))
            for doc, ranges in marks.items():
                hit[a + doc] = _merged(ranges)
        if not first_pass:
            old = batch.column(batch.schema.get_field_index("spans")).to_pylist()
            old_items = batch.column(batch.schema.get_field_index("found_items")).to_pylist()
            for k in range(rows):
                if old[k]:
                    hit[k] = _merged([(s["first"], s["last"]) for s in old[k] + hit[k]])
                items[k].update(old_items[k])
            batch = batch.select([c for c in batch.schema.names if c not in ("n_words", "spans", "found_items")])
        span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(counts), pa.array(hit, span), pa.array([sorted(i) for i in items], pa.list_(pa.string()))],
            [*batch.schema.names, "n_words", "spans", "found_items"],
        )

    return search


def _merged(ranges: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1]["last"]:
            out[-1]["last"] = max(out[-1]["last"], last)
        else:
            out.append({"first": first, "last": last})
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with the columns of ``docs``."""
    return mark_hits(docs, benchmark, text).where("n_hit = 0").select(*(F.col(f"`{c}`") for c in docs.columns))
