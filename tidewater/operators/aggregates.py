"""Keyed aggregates over whole inputs. All of them are combined before the shuffle, so hot keys are no burden."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pandas.core.groupby import DataFrameGroupBy
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidewater.functions.layout import layout
from tidewater.operators.ordered import KeyedSequence, running_count, running_max, running_min


def first_by(columns: list[str], order: list[str]) -> Column:
    """The named columns of the first row in ``order``, as a struct."""
    return F.min_by(F.struct(*columns), F.struct(*order))


def max_field(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """The maximum of one field per key; all other fields come from the key's first row."""
    rest = [c for c in df.columns if c not in keys and c != value]
    done = df.groupBy(*keys).agg(F.max(value).alias(value), first_by(rest, order).alias("_first"))
    return done.select(*[F.col(f"_first.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def max_field_running(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """Per row: the maximum so far in ``value`` and all other fields of the key's first row; the order columns stay."""
    rest = [c for c in df.columns if c not in keys and c != value]
    sequence = KeyedSequence(df, keys, order)
    done = sequence.running(_max=running_max(value), _first=running_min(F.struct(*order, F.struct(*rest).alias("_rest"))))
    fields = {c: F.col(f"_first._rest.{c}") for c in rest if c not in order}
    return done.rows().select(
        *[F.col("_max").alias(c) if c == value else fields.get(c, F.col(c)).alias(c) for c in df.columns]
    )


def max_record(df: DataFrame, keys: list[str], value: str, seq: str) -> DataFrame:
    """The whole row that holds the key's maximum; the earliest one on ties."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(F.col(value), -F.col(seq))).alias("_best")
    done = df.groupBy(*keys).agg(best)
    return done.select(*[F.col(f"_best.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def max_record_running(df: DataFrame, keys: list[str], value: str, seq: str, prefix: str = "best_") -> DataFrame:
    """Per row: the fields (under ``prefix``) of the row that holds the maximum so far."""
    rest = [c for c in df.columns if c not in keys]
    entry = F.struct(F.col(value).alias("_v"), (-F.col(seq)).alias("_s"), F.struct(*rest).alias("_row"))
    done = KeyedSequence(df, keys, [seq]).running(_best=running_max(entry)).rows()
    return done.select(*df.columns, *[F.col(f"_best._row.{c}").alias(prefix + c) for c in rest])


def distinct_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every distinct key."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    done = df.groupBy(*keys).agg(first_by(rest, order).alias("_first"))
    return done.select(*[F.col(f"_first.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def running_distinct(df: DataFrame, key: str, seq: str, out: str = "uv") -> DataFrame:
    """One row ``(key, seq, out)`` at the first sight of each key: how many distinct keys were seen so far."""
    firsts = df.groupBy(key).agg(F.min(seq).alias(seq))
    return KeyedSequence(firsts, [], [seq]).running(**{out: running_count()}).rows()


def ordinal(df: DataFrame, order: list[str], out: str = "n") -> DataFrame:
    """Number all rows 1, 2, 3, ... in ``order``."""
    return KeyedSequence(df, [], order).running(**{out: running_count()}).rows()


class Aggregator(ABC):
    """An aggregate in pandas for what column expressions cannot say; prefer ``F.sum`` and friends.

    ``schema`` is the layout of an accumulator and ``columns`` are the inputs. All three steps work on whole blocks of
    groups at once. Accumulators must merge, in any grouping of the rows.
    """

    schema: str
    columns: list[str]
    result_schema: str | None = None

    @abstractmethod
    def partial(self, groups: DataFrameGroupBy) -> pd.DataFrame:
        """Accumulators of some of the rows of each group."""

    @abstractmethod
    def merge(self, groups: DataFrameGroupBy) -> pd.DataFrame:
        """One accumulator per group from several."""

    def result(self, accumulators: pd.DataFrame) -> pd.DataFrame:
        """Final columns (``result_schema``) next to the key columns."""
        return accumulators


def aggregate_with(df: DataFrame, keys: list[str], aggregator: Aggregator, held: int = 100_000) -> DataFrame:
    """Aggregate per key with an ``Aggregator``.

    Whole numbers and booleans arrive in pandas' nullable types, so NULL leaves them as they are; NULL keys form a group.

    Each input task first builds its own accumulators (at most about ``held`` at a time), so a key arrives at the
    merging task about once per input task and not once per row; the merge streams over accumulators sorted by key.
    """
    df = df.select(*keys, *[c for c in aggregator.columns if c not in keys])
    key_fields = [df.schema[k] for k in keys]
    partial_schema = T.StructType([*key_fields, *layout(aggregator.schema)])
    final_schema = T.StructType([*key_fields, *layout(aggregator.result_schema or aggregator.schema)])

    def grouped(rows: pd.DataFrame) -> DataFrameGroupBy:
        return rows.groupby(keys, dropna=False, sort=False)

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        return aggregator.merge(grouped(rows)).reset_index()[partial_schema.names]

    def frames(batches: Iterable[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.num_rows:
                yield batch.to_pandas(types_mapper=_NULLABLE.get)

    def table(rows: pd.DataFrame, schema: T.StructType) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])
        yield from pa.Table.from_pandas(rows[schema.names], kinds, preserve_index=False, safe=True).to_batches()

    def partials(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, rows = [], 0
        for frame in frames(batches):
            blocks.append(aggregator.partial(grouped(frame)).reset_index()[partial_schema.names])
            rows += len(blocks[-1])
            if rows >= held:
                blocks = [merge(pd.concat(blocks))]
                rows = len(blocks[0])
                if rows >= held // 2:
                    yield from table(blocks.pop(), partial_schema)
                    rows = 0
        if blocks:
            yield from table(merge(pd.concat(blocks)), partial_schema)

    def merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for frame in frames(batches):
            done = merge(frame if last is None else pd.concat([last, frame]))
            last = done.iloc[-1:]
            if len(done) > 1:
                yield from table(aggregator.result(done.iloc[:-1]), final_schema)
        if last is not None:
            yield from table(aggregator.result(last), final_schema)

    parts = df.mapInArrow(partials, partial_schema)
    return parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(merged, final_schema)


_NULLABLE = {
    pa.int8(): pd.Int8Dtype(),
    pa.int16(): pd.Int16Dtype(),
    pa.int32(): pd.Int32Dtype(),
    pa.int64(): pd.Int64Dtype(),
    pa.bool_(): pd.BooleanDtype(),
}


def reduce_in_order(
    df: DataFrame, keys: list[str], order: list[str], function: Callable[[dict, dict], dict], parts: int | None = None
) -> DataFrame:
    """Reduce the rows of each key pairwise, in ``order``, with a Python function of two rows without keys and order.

    ``function`` must be associative; it need not commute. Rows are range-partitioned on key and order, so a task holds a
    stretch of the order and gives one row for each of its keys, and a hot key is spread over tasks. The few rows that a
    key has left, one per task that held it, are reduced in a second step. A single row stays as it is.
    """
    values = [c for c in df.columns if c not in keys and c not in order]
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = len(keys) + len(order)

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held, schema = None, None, None
        for batch in batches:
            schema, done = batch.schema, []
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                value = dict(zip(values, row[width:]))
                if head is not None and head[: len(keys)] == row[: len(keys)]:
                    held = function(held, value)
                else:
                    if head is not None:
                        done.append((*head, *[held[c] for c in values]))
                    head, held = row[:width], value
            if done:
                yield _batch(done, schema)
        if head is not None:
            yield _batch([(*head, *[held[c] for c in values])], schema)

    rows = df.select(*keys, *order, *values)
    some = rows.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order).mapInArrow(fold, rows.schema)
    return some.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(fold, rows.schema).select(*keys, *values)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def apply_to_windows(
    df: DataFrame, keys: list[str], ts: str, width_ms: int, function: Callable[[tuple, int, pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Call ``function(key, window start in ms, rows)`` for every key and tumbling window; its frames follow the keys and the start.

    All rows of one window of one key are in memory at a time: choose the width so that they fit. Every window costs a
    call in pandas, a few milliseconds: millions of windows belong into columns. What combines belongs into ``aggregate_with``
    or an ordinary aggregate.
    """
    from tidewater.operators.windows import floor_to, millis

    placed = df.withColumn("win_start_ms", floor_to(millis(ts), width_ms)).where("win_start_ms is not null")
    out = T.StructType([*[df.schema[k] for k in keys], T.StructField("win_start_ms", T.LongType()), *layout(schema)])

    def run(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        done = function(group[:-1], int(group[-1]), rows.drop(columns=[*keys, "win_start_ms"]))
        for at, name in enumerate([*keys, "win_start_ms"]):
            done.insert(at, name, pd.Series([group[at]] * len(done), index=done.index, dtype=object))
        return done

    return placed.groupBy(*keys, "win_start_ms").applyInPandas(run, out)
