"""Exact late-row splitting on a stream.

Spark drops late rows inside its own operators and moves the watermark only between micro-batches. Where late rows
must be kept, and judged as if the watermark moved after every row, each micro-batch is classified by the batch
replay, starting from the greatest event time seen before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidewater.operators.late import ASIDE, LATE, ON_TIME, lateness_class
from tidewater.operators.merging import ASIDE_ROW, FIRE, OPEN, walk
from tidewater.operators.ordered import KeyedSequence, running_max, running_sum
from tidewater.operators.windows import floor_to, window_starts
from tidewater.session import checkpointed, remove_folder

Sink = Callable[[DataFrame, int], None]


class LateSplitter:
    """Sends rows to ``main`` (with their class) or ``aside``.

    ``memory`` is a folder all executors and later runs can reach. The greatest event time after each micro-batch is
    kept there under the batch number, so a repeated batch starts from the same value as the first time; what is older
    than the last ``keep`` batches is removed.
    """

    keep = 100  # as many as Spark's own checkpoints

    def __init__(
        self,
        ts_ms: str,
        order: list[str],
        size_ms: int,
        slide_ms: int,
        delay_ms: int,
        lateness_ms: int,
        main: Sink,
        aside: Sink,
        memory: str,
    ):
        self.ts_ms, self.order = ts_ms, order
        self.size, self.slide, self.delay, self.lateness = size_ms, slide_ms, delay_ms, lateness_ms
        self.main, self.aside, self.memory = main, aside, memory.rstrip("/")

    def attach(self, stream: DataFrame) -> DataStreamWriter:
        return stream.writeStream.foreachBatch(self)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self._greatest_before(batch.sparkSession, batch_id)
        batch = batch.persist()
        try:
            rows = self._seen(batch, before)
            newest = floor_to(F.col(self.ts_ms), self.slide)
            rows = rows.withColumn("lateness", lateness_class(newest, self.size, self.lateness, F.col("wm_before")))
            self.main(rows.where(F.col("lateness") != ASIDE), batch_id)
            self.aside(rows.where(F.col("lateness") == ASIDE), batch_id)
            self._remember(batch, before, batch_id)
        finally:
            batch.unpersist()

    def _seen(self, batch: DataFrame, before: int | None) -> DataFrame:
        """The rows with the watermark before each."""
        rows = KeyedSequence(batch, [], self.order).running(_peak=running_max(self.ts_ms, inclusive=False)).rows()
        peak = F.greatest(F.col("_peak"), F.lit(before).cast("bigint"))
        return rows.withColumn("wm_before", peak - F.lit(self.delay + 1)).drop("_peak")

    def _remember(self, batch: DataFrame, before: int | None, batch_id: int) -> None:
        latest = batch.agg(F.max(self.ts_ms).alias("ms")).select(F.greatest("ms", F.lit(before).cast("bigint")).alias("ms"))
        latest.write.mode("overwrite").parquet(f"{self.memory}/batch={batch_id}")
        remove_folder(batch.sparkSession, f"{self.memory}/batch={batch_id - self.keep}")

    def _greatest_before(self, spark: SparkSession, batch_id: int) -> int | None:
        if batch_id == 0:
            return None
        return spark.read.parquet(f"{self.memory}/batch={batch_id - 1}").first()[0]


class LateWindows(LateSplitter):
    """Window sums with re-firings: what ``operators.late_updates`` gives, for any cut of the stream into micro-batches.

    ``emit`` receives ``keys, win_start_ms, fire_no, value``: the first firing of a window once the watermark has passed
    it, then one for every accepted late row. ``aside`` receives rows that came too late for all their windows. Open windows
    are kept in ``memory`` next to the watermark: one row for each key and window within the delay and lateness.
    """

    def __init__(
        self,
        keys: list[str],
        ts_ms: str,
        order: list[str],
        size_ms: int,
        slide_ms: int,
        delay_ms: int,
        lateness_ms: int,
        value: Column,
        emit: Sink,
        aside: Sink,
        memory: str,
    ):
        super().__init__(ts_ms, order, size_ms, slide_ms, delay_ms, lateness_ms, emit, aside, memory)
        self.keys, self.value = keys, value

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self._greatest_before(spark, batch_id)
        batch = batch.persist()
        try:
            group, last = [*self.keys, "win_start_ms"], F.col("win_start_ms") + F.lit(self.size - 1)
            rows = self._seen(batch, before)
            newest = lateness_class(floor_to(F.col(self.ts_ms), self.slide), self.size, self.lateness, F.col("wm_before"))
            self.aside(rows.where(newest == ASIDE).drop("wm_before"), batch_id)
            placed = rows.select(
                *self.keys, *self.order, "wm_before", self.value.alias("_value"),
                F.explode(window_starts(F.col(self.ts_ms), self.size, self.slide)).alias("win_start_ms"),
            )
            placed = placed.withColumn("_class", lateness_class(F.col("win_start_ms"), self.size, self.lateness, F.col("wm_before")))
            peak = F.greatest(F.max(self.ts_ms), F.lit(before).cast("bigint"))
            reached = batch.agg(peak.alias("ms")).first()["ms"]
            watermark = F.lit(None if reached is None else reached - self.delay - 1).cast("bigint")

            on_time = placed.where(F.col("_class") == ON_TIME).groupBy(*group).agg(F.sum("_value").alias("total"))
            held = on_time.withColumns({"fires": F.lit(0).cast("bigint"), "_fresh": F.lit(True)})
            if batch_id:
                old = spark.read.parquet(f"{self.memory}/windows/batch={batch_id - 1}").withColumn("_fresh", F.lit(False))
                held = held.unionByName(old)
            held = held.groupBy(*group).agg(F.sum("total").alias("total"), F.max("fires").alias("fires"))
            due = (F.col("fires") == 0) & (last <= watermark)
            held = checkpointed(held.withColumns({"_due": F.coalesce(due, F.lit(False))}))
            first = held.where("_due").select(*group, F.lit(1).cast("bigint").alias("fire_no"), F.col("total").alias("value"))

            known = held.select(*group, F.col("total").alias("_value"), (F.col("fires") + F.col("_due").cast("bigint")).alias("_n"))
            late = placed.where(F.col("_class") == LATE).select(*group, *self.order, "_value", F.lit(1).cast("bigint").alias("_n"))
            # What a window holds precedes its late rows: its order columns are NULL, which sorts first.
            rows = late.withColumn("_new", F.lit(True)).unionByName(known.withColumn("_new", F.lit(False)), allowMissingColumns=True)
            done = KeyedSequence(checkpointed(rows), group, self.order).running(fire_no=running_sum("_n"), value=running_sum("_value"))
            done = checkpointed(done.rows())
            again = done.where("_new").select(*group, "fire_no", "value")
            self.main(first.unionByName(again), batch_id)

            kept = done.groupBy(*group).agg(F.max_by("value", "fire_no").alias("total"), F.max("fire_no").alias("fires"))
            kept = kept.where(watermark.isNull() | (last + F.lit(self.lateness) > watermark))
            kept.write.mode("overwrite").parquet(f"{self.memory}/windows/batch={batch_id}")
            remove_folder(spark, f"{self.memory}/windows/batch={batch_id - self.keep}")
            self._remember(batch, before, batch_id)
        finally:
            batch.unpersist()


class LateSessions(LateSplitter):
    """Merging sessions with re-firings: what ``operators.merging_sessions`` gives, for any cut of the stream into micro-batches.

    ``emit`` receives ``keys, session_start_ms, session_end_ms, folds`` for every firing, ``aside`` the dropped rows as ``keys, order, ts_ms``. Between
    micro-batches only sessions that are still open are kept in ``memory``: those within the delay and lateness of the
    watermark. ``folds`` are ``name=(kind, value)``.
    """

    def __init__(
        self,
        keys: list[str],
        ts_ms: str,
        order: list[str],
        gap_ms: int,
        delay_ms: int,
        lateness_ms: int,
        emit: Sink,
        aside: Sink,
        memory: str,
        **folds: tuple[str, Column],
    ):
        super().__init__(ts_ms, order, gap_ms, gap_ms, delay_ms, lateness_ms, emit, aside, memory)
        self.keys, self.folds = keys, folds

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self._greatest_before(spark, batch_id)
        batch = batch.where(F.col(self.ts_ms).isNotNull()).persist()
        try:
            values = {f"_fold_{name}": value for name, (_, value) in self.folds.items()}
            kinds = [kind for kind, _ in self.folds.values()]
            peak = F.greatest(F.max(self.ts_ms), F.lit(before).cast("bigint"))
            reached = batch.agg(peak.alias("ms")).first()["ms"]
            columns = list(dict.fromkeys([*self.keys, *self.order, self.ts_ms]))
            rows = self._seen(batch, before).select(*columns, "wm_before", *[v.alias(n) for n, v in values.items()])
            rows = rows.withColumn("_open", F.lit(False))
            if batch_id:
                held = spark.read.parquet(f"{self.memory}/sessions/batch={batch_id - 1}").withColumn("_open", F.lit(True))
                rows = rows.unionByName(held, allowMissingColumns=True)
            else:
                rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in (("_first", "bigint"), ("_last", "bigint"), ("_fired", "boolean"))})
            until = None if reached is None else reached - self.delay - 1
            rows = rows.withColumn("_until", F.lit(until).cast("bigint"))
            told = walk(rows, self.keys, self.ts_ms, self.order, self.size, self.lateness, kinds, list(values), "_until")
            told = checkpointed(told)
            fired = told.where(F.col("_kind") == FIRE)
            shown = [F.col(f"_fold_{name}").alias(name) for name in self.folds]
            end = (F.col("_last") + F.lit(self.size)).alias("session_end_ms")
            self.main(fired.select(*self.keys, F.col("_first").alias("session_start_ms"), end, *shown), batch_id)
            extra = [c for c in self.order if c not in self.keys]
            late = told.where(F.col("_kind") == ASIDE_ROW)
            self.aside(late.select(*self.keys, *extra, F.col("_first").alias(self.ts_ms)), batch_id)
            left = told.where(F.col("_kind") == OPEN).select(*self.keys, "_first", "_last", "_fired", *values)
            left.write.mode("overwrite").parquet(f"{self.memory}/sessions/batch={batch_id}")
            remove_folder(spark, f"{self.memory}/sessions/batch={batch_id - self.keep}")
            self._remember(batch, before, batch_id)
        finally:
            batch.unpersist()
