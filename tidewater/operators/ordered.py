"""Ordered computation per key, also when one key holds much of the data.

``Window.partitionBy(key).orderBy(seq)`` is the right plan as long as no key outgrows a task. ``KeyedSequence`` uses
exactly that plan then. For a key that is too big, and for computations without a key at all, the key's rows are cut
into *chunks* that follow the order, every chunk is its own window partition, and each chunk first receives a few
*seed* rows that stand for everything before it:

* running sums, counts, minima and maxima: one row with the aggregate of all earlier chunks;
* look-back of ``n`` rows: the last ``n`` rows before the chunk;
* running top ``n``: the best ``n`` rows of all earlier chunks.

Seeds sort before the chunk's own rows, take part in the window frame, and are dropped afterwards. So results are
the same as with the plain plan, there is no join back, and NULL keys need no special care.

Seeds are themselves found chunk by chunk: chunks of integers are ranges of ``2**bits`` values, these form ranges of
``2**bits`` chunks, and so on. With the 21 bits of the default, two levels above the rows cover all 63-bit integers, dense or
hashed, so that no window partition holds more than ``2**21`` distinct order values, chunks or groups of chunks
(times the few rows that a seed hands on). Orders that are not integers are cut by measured ranges of about ``chunkRows`` rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import checkpointed, setting

CHUNK = "_chunk"
LIVE = "_live"

# Rows of a key that the search for hot keys should meet.
SEEN = 1_000
# Levels above the rows; ``63 / 21 - 1``.
LEVELS = 2

_AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min}


@dataclass(frozen=True)
class Running:
    """A running aggregate: ``kind`` of ``value`` over the rows up to this one (or only those before it)."""

    kind: str
    value: Column
    inclusive: bool = True


def running_sum(value: Column | str, inclusive: bool = True) -> Running:
    return Running("sum", F.col(value) if isinstance(value, str) else value, inclusive)


def running_count(condition: Column | None = None, inclusive: bool = True) -> Running:
    one = F.lit(1).cast("bigint")
    return Running("sum", one if condition is None else F.when(condition, one).otherwise(F.lit(0)), inclusive)


def running_max(value: Column | str, inclusive: bool = True) -> Running:
    return Running("max", F.col(value) if isinstance(value, str) else value, inclusive)


def running_min(value: Column | str, inclusive: bool = True) -> Running:
    return Running("min", F.col(value) if isinstance(value, str) else value, inclusive)


def hot_share(spark: SparkSession) -> float:
    """The share of the rows that the search for hot keys looks at."""
    return min(1.0, SEEN / setting(spark, "hotRows", 1_000_000))


def hot_keys(df: DataFrame, keys: list[str], looked_at: DataFrame | None = None) -> DataFrame | None:
    """Keys with at least ``spark.tidewater.hotRows`` rows, with their estimated row count; None if there is none.

    This only decides how rows are laid out over tasks. It therefore counts a share of the rows (``looked_at``, or a sample)
    in which a hot key still shows up about a thousand times: a key that is missed, or listed without need, costs time
    but changes no result. If there is one, all keys found are written to the checkpoint folder; the driver learns only
    whether there is one.
    """
    spark = df.sparkSession
    share = hot_share(spark)
    if looked_at is None:
        looked_at = df.select(*keys) if share == 1.0 else df.select(*keys).sample(share, seed=7)
    least = setting(spark, "hotRows", 1_000_000)
    found = (
        looked_at.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") >= (least if share == 1.0 else int(0.8 * least * share)))
        .withColumn("_rows", (F.col("_rows") / F.lit(share)).cast("bigint"))
    )
    return checkpointed(found) if found.take(1) else None


class KeyedSequence:
    """Rows of ``df`` in ``order`` within ``keys``; no keys means one global sequence.

    The first order column decides how hot keys are cut. If it is an integer (an arrival number, close to unique
    within a key) a chunk is a fixed range of it, planned without touching the data. Otherwise (time stamps, which may
    repeat without bound) the hot rows are range-partitioned on key and full order and written to the checkpoint
    folder, so that the chunk numbers stay fixed. ``known_cold`` skips the search for hot keys; ``looked_at`` is a share
    ``hot_share`` of the rows, for callers that can draw it more cheaply.
    """

    def __init__(
        self, df: DataFrame, keys: list[str], order: list[str], known_cold: bool = False, looked_at: DataFrame | None = None
    ):
        self.keys = list(keys)
        self.order = list(order)
        spark = df.sparkSession
        self._bits = setting(spark, "chunkBits", 21)
        self._levels = LEVELS
        self.split = False
        self.df = df
        hot = hot_keys(df, self.keys, looked_at) if keys and not known_cold else None
        if keys and hot is None:
            return
        self.split = True
        if keys:
            names = {k: f"_hot_{i}" for i, k in enumerate(self.keys)}
            renamed = hot.withColumnsRenamed(names)
            same = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
            df = df.join(renamed, same, "left").drop(*names.values())
        else:
            df = df.withColumn("_rows", F.lit(1))
        is_hot = F.col("_rows").isNotNull()
        if isinstance(df.schema[self.order[0]].dataType, T.IntegralType):
            lead = F.coalesce(F.col(self.order[0]).cast("bigint"), F.lit(-(2**62)))
            self.df = df.withColumn(CHUNK, F.when(is_hot, F.shiftright(lead, self._bits))).drop("_rows")
            return
        rows = hot.agg(F.sum("_rows")).first()[0] if keys else df.count()
        parts = max(1, math.ceil(rows / setting(spark, "chunkRows", 1_000_000)))
        self._levels = 1  # as many chunks as partitions
        heavy = (
            df.where(is_hot)
            .drop("_rows")
            .repartitionByRange(parts, *self.keys, *self.order)
            .withColumn(CHUNK, F.spark_partition_id().cast("bigint"))
        )
        light = df.where(~is_hot).drop("_rows").withColumn(CHUNK, F.lit(None).cast("bigint"))
        self.df = light.unionByName(checkpointed(heavy)) if keys else checkpointed(heavy)

    @property
    def group(self) -> list[str]:
        """Columns of one window partition."""
        return [*self.keys, CHUNK] if self.split else self.keys

    def rows(self) -> DataFrame:
        return self.df.drop(CHUNK)

    def _with(self, df: DataFrame) -> KeyedSequence:
        other = object.__new__(KeyedSequence)
        other.__dict__.update(self.__dict__)
        other.df = df
        return other

    def where(self, condition: Column) -> KeyedSequence:
        return self._with(self.df.where(condition))

    def select(self, *columns: Column | str) -> KeyedSequence:
        return self._with(self.df.select(*columns, *([CHUNK] if self.split else [])))

    def running(self, **folds: Running) -> KeyedSequence:
        """Add one running aggregate per keyword."""
        inputs = {f"_in_{name}": fold for name, fold in folds.items()}
        data = self.df.select("*", *[fold.value.alias(column) for column, fold in inputs.items()])
        outputs = {column: column.removeprefix("_in_") for column in inputs}
        done = _fold(data, self.keys, self.order, inputs, outputs, CHUNK if self.split else None, self._bits, self._levels)
        return self._with(done.drop(*inputs))

    def with_window(self, back: int, build: Callable[[WindowSpec], dict[str, Column]]) -> KeyedSequence:
        """Add window columns that look back at most ``back`` rows, e.g. ``lag`` or a ``rowsBetween(-back, 0)`` frame."""
        window = Window.partitionBy(*self.group).orderBy(*self.order)
        if not self.split:
            return self._with(self.df.withColumns(build(window)))
        seeded = self._seed(self._rows_before(self._last(self.df.where(F.col(CHUNK).isNotNull()), back, CHUNK), back, CHUNK, self._levels))
        return self._with(seeded.withColumns(build(window)).where(LIVE).drop(LIVE))

    def _last(self, df: DataFrame, back: int, chunk: str) -> DataFrame:
        """The last ``back`` rows of every chunk."""
        latest_first = Window.partitionBy(*self.keys, chunk).orderBy(*[F.desc(c) for c in self.order])
        return df.withColumn("_nth", F.row_number().over(latest_first)).where(F.col("_nth") <= back).drop("_nth")

    def _rows_before(self, tails: DataFrame, back: int, chunk: str, levels: int) -> DataFrame:
        """For every chunk but a key's first, the ``back`` rows before it, with ``CHUNK`` naming the chunk they precede."""
        tails, group, seeds = self._grouped(tails, chunk, levels, lambda t, up: self._rows_before(self._last(t, back, up), back, up, levels - 1))
        data = tails if seeds is None else tails.unionByName(seeds, allowMissingColumns=True)
        window = Window.partitionBy(*group).orderBy(LIVE, *self.order)
        names = [c for c in self.df.columns if c != CHUNK]
        recent = F.collect_list(F.struct(*names)).over(window.rowsBetween(-(back - 1), 0))
        last = self._borders(data.withColumn("_digest", recent), chunk, window)
        return last.select(F.explode("_digest").alias("_row"), F.col("_next").alias(CHUNK)).select("_row.*", CHUNK)

    def _grouped(self, digest: DataFrame, chunk: str, levels: int, above: Callable[[DataFrame, str], DataFrame]):
        """(digest marked live, window columns, seeds from the level above or None)."""
        live = digest.withColumn(LIVE, F.lit(True))
        if levels == 1:
            return live, self.keys, None
        up = f"{chunk}_"
        live = live.withColumn(up, F.shiftright(chunk, self._bits))
        seeds = above(live.drop(LIVE), up).withColumnRenamed(CHUNK, up).withColumn(LIVE, F.lit(False))
        return live, [*self.keys, up], seeds

    @staticmethod
    def _borders(data: DataFrame, chunk: str, window: WindowSpec) -> DataFrame:
        """The last row before every next chunk of its window partition; ``_next`` is that chunk."""
        data = data.withColumn("_next", F.lead(chunk).over(window))
        return data.where(F.col("_next").isNotNull() & ~F.col("_next").eqNullSafe(F.col(chunk)))

    def running_top(self, n: int, value: str, seq: str, out: str) -> KeyedSequence:
        """Add ``out``: the best ``n`` rows so far as an array of structs (value, -seq), largest value first, earlier first on ties.

        A list of bounded length is kept by window functions alone: rank 1 is the running maximum, the loser of each
        step (the new row or the one it displaced) falls through to rank 2, whose running maximum is the second
        best, and so on.
        """
        entry = F.struct(F.col(value).alias("value"), (-F.col(seq)).alias("neg_seq"))
        data = self._with(self.df.withColumn("_entry", entry))
        if self.split:
            carried = self._best_before(data.df.where(F.col(CHUNK).isNotNull()), n, CHUNK, self._levels)
            seeds = carried.select(
                *self.keys, CHUNK, "_entry", (-F.col("_entry.neg_seq")).cast(data.df.schema[seq].dataType).alias(seq)
            )
            data = self._with(data._seed(seeds))
        window = Window.partitionBy(*self.group).orderBy(*([LIVE] if self.split else []), *self.order)
        done = _cascade(data.df, n, window, out).drop("_entry")
        return self._with(done.where(LIVE).drop(LIVE) if self.split else done)

    def _best_before(self, rows: DataFrame, n: int, chunk: str, levels: int) -> DataFrame:
        """For every chunk but a key's first, the ``n`` best entries before it, with ``CHUNK`` naming the chunk they precede."""
        best_first = Window.partitionBy(*self.keys, chunk).orderBy(F.desc("_entry"))
        best = rows.withColumn("_nth", F.row_number().over(best_first)).where(F.col("_nth") <= n).select(*self.keys, chunk, "_entry")
        best, group, seeds = self._grouped(best, chunk, levels, lambda t, up: self._best_before(t, n, up, levels - 1))
        data = best if seeds is None else best.unionByName(seeds, allowMissingColumns=True)
        window = Window.partitionBy(*group).orderBy(LIVE, chunk, "_entry")
        last = self._borders(_cascade(data, n, window, "_top"), chunk, window)
        return last.select(*self.keys, F.explode("_top").alias("_entry"), F.col("_next").alias(CHUNK))

    def _seed(self, seeds: DataFrame) -> DataFrame:
        return self.df.withColumn(LIVE, F.lit(True)).unionByName(
            seeds.withColumn(LIVE, F.lit(False)), allowMissingColumns=True
        )


def _cascade(df: DataFrame, n: int, window: WindowSpec, out: str) -> DataFrame:
    upto = window.rowsBetween(Window.unboundedPreceding, 0)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_falls_0", F.col("_entry"))
    for rank in range(n):
        falling = F.col(f"_falls_{rank}")
        df = df.withColumns({f"_best_{rank}": F.max(falling).over(upto), "_held": F.max(falling).over(before)})
        df = df.withColumn(f"_falls_{rank + 1}", F.when(falling < F.col("_held"), falling).otherwise(F.col("_held")))
    best = F.filter(F.array(*[f"_best_{rank}" for rank in range(n)]), lambda e: e.isNotNull())
    scratch = [f"_best_{r}" for r in range(n)] + [f"_falls_{r}" for r in range(n + 1)] + ["_held"]
    return df.withColumn(out, best).drop(*scratch)


def _fold(
    data: DataFrame,
    keys: list[str],
    order: list[str],
    inputs: dict[str, Running],
    outputs: dict[str, str],
    chunk: str | None,
    bits: int,
    levels: int,
) -> DataFrame:
    """Running aggregates of the input columns; chunk seeds come from the same function one level up, at most ``2**bits``
    of them in one window partition where the levels cover the chunk numbers.
    """
    group = [*keys, chunk] if chunk else keys
    if chunk:
        digest = (
            data.where(F.col(chunk).isNotNull())
            .groupBy(*group)
            .agg(*[_AGGREGATES[fold.kind](column).alias(column) for column, fold in inputs.items()])
        )
        above = f"{chunk}_" if levels > 1 else None
        if above:
            digest = digest.withColumn(above, F.shiftright(chunk, bits))
        earlier = {column: Running(fold.kind, fold.value, False) for column, fold in inputs.items()}
        seeds = _fold(digest, keys, [chunk], earlier, {c: f"{c}_" for c in inputs}, above, bits, levels - 1)
        seeds = seeds.select(*group, *[F.col(f"{c}_").alias(c) for c in inputs])
        data = data.withColumn(LIVE, F.lit(True)).unionByName(
            seeds.withColumn(LIVE, F.lit(False)), allowMissingColumns=True
        )
        order = [LIVE, *order]
    window = Window.partitionBy(*group).orderBy(*order)
    columns = []
    for column, fold in inputs.items():
        frame = window.rowsBetween(Window.unboundedPreceding, 0 if fold.inclusive else -1)
        columns.append(_AGGREGATES[fold.kind](column).over(frame).alias(outputs[column]))
    done = data.select("*", *columns)
    return done.where(LIVE).drop(LIVE) if chunk else done
