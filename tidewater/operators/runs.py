"""User functions over the ordered rows of a window, row after row: no window is held in memory."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewater.functions.layout import layout
from tidewater.operators.windows import floor_to, millis

_ROWS = 10_000

Walk = Callable[[tuple, int, Iterator[tuple]], Iterator[tuple]]


def walk_windows(df: DataFrame, keys: list[str], ts: str, width_ms: int, order: list[str], values: list[str], function: Walk, schema: str) -> DataFrame:
    """``keys, win_start_ms`` and the ``schema`` of the tuples that ``function(key, window start in ms, rows)`` yields.

    ``rows`` yields the ``values`` of one tumbling window of one key, sorted by ``order``, as tuples; the function may stop early. Rows come
    from Arrow batches of the sorted partition, so a window may be larger than memory. What combines belongs into an
    ordinary aggregate. Rows without a time are left out.
    """
    group = [*keys, "win_start_ms"]
    placed = df.withColumn("win_start_ms", floor_to(millis(ts), width_ms)).where("win_start_ms is not null")
    columns = [*group, *values, *[c for c in order if c not in (*group, *values)]]
    rows = placed.select(*columns).repartition(*group).sortWithinPartitions(*group, *order)
    out = T.StructType([*[df.schema[k] for k in keys], T.StructField("win_start_ms", T.LongType()), *layout(schema)])
    width, used = len(group), len(group) + len(values)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, made = to_arrow_schema(out), _results(_tuples(batches), width, used, function)
        while held := list(islice(made, _ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    return rows.mapInArrow(run, out)


def _tuples(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            yield from zip(*[column.to_pylist() for column in batch.slice(start, _ROWS).columns])


def _results(rows: Iterator[tuple], width: int, used: int, function: Walk) -> Iterator[tuple]:
    following = next(rows, None)

    def window(group: tuple) -> Iterator[tuple]:
        nonlocal following
        while following is not None and following[:width] == group:
            row, following = following, next(rows, None)
            yield row[width:used]

    while following is not None:
        group = following[:width]
        own = window(group)
        for result in function(group[:-1], group[-1], own):
            yield (*group, *result)
        for _ in own:  # what the function did not look at
            pass
