"""Watermarks and late rows over tables: what a stream that moves its watermark after every row would have done.

``order`` is the arrival order. The watermark before a row is the greatest event time among earlier rows minus the
delay minus one millisecond. A window ``[start, end)`` fires when the watermark reaches ``end - 1`` and closes when it
reaches ``end - 1 + lateness``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.ordered import KeyedSequence, running_count, running_max, running_sum
from tidewater.operators.windows import MERGE, floor_to, oldest_start, window_starts
from tidewater.session import checkpointed

ON_TIME, LATE, ASIDE = "on_time", "late_accepted", "side_output"


def replay_watermark(df: DataFrame, ts_ms: str, order: list[str], delay_ms: int, out: str = "wm_before") -> DataFrame:
    """Add the watermark (epoch ms) that was current when the row arrived; NULL before the first one."""
    seen = KeyedSequence(df, [], order).running(**{out: running_max(ts_ms, inclusive=False)}).rows()
    return seen.withColumn(out, F.col(out) - F.lit(delay_ms + 1))


def lateness_class(start: Column, size_ms: int, lateness_ms: int, watermark: Column) -> Column:
    """The class of a row for the window that starts at ``start``."""
    last = start + F.lit(size_ms - 1)
    return (
        F.when(watermark.isNull() | (last > watermark), F.lit(ON_TIME))
        .when(last + F.lit(lateness_ms) > watermark, F.lit(LATE))
        .otherwise(F.lit(ASIDE))
    )


def classify(
    df: DataFrame, ts_ms: str, order: list[str], size_ms: int, slide_ms: int, delay_ms: int, lateness_ms: int
) -> DataFrame:
    """Add ``wm_before`` and ``lateness``, judged by the newest window of the row: aside means all its windows are closed."""
    seen = replay_watermark(df, ts_ms, order, delay_ms)
    newest = floor_to(F.col(ts_ms), slide_ms)
    return seen.withColumn("lateness", lateness_class(newest, size_ms, lateness_ms, F.col("wm_before")))


def late_updates(
    df: DataFrame,
    keys: list[str],
    ts_ms: str,
    order: list[str],
    size_ms: int,
    delay_ms: int,
    lateness_ms: int,
    value: Column,
    slide_ms: int | None = None,
) -> DataFrame:
    """Every result a tumbling or sliding window emits: ``keys, win_start_ms, fire_no, value``.

    The first firing holds all rows that were on time; each accepted late row fires again with the new total, in every one of
    its windows that had fired and is still open. Rows on time are summed before the shuffle, only late rows are
    put in order.
    """
    slide_ms = slide_ms or size_ms
    seen = replay_watermark(df, ts_ms, order, delay_ms)
    placed = seen.select(
        *keys, *order, "wm_before", value.alias("_value"), F.explode(window_starts(F.col(ts_ms), size_ms, slide_ms)).alias("win_start_ms")
    )
    lateness = lateness_class(F.col("win_start_ms"), size_ms, lateness_ms, F.col("wm_before"))
    placed = placed.withColumn("lateness", lateness).drop("wm_before")
    group = [*keys, "win_start_ms"]
    first = placed.where(F.col("lateness") == ON_TIME).groupBy(*group).agg(F.sum("_value").alias("_value"))
    # The first firing precedes every late row: its order columns are NULL, which sorts first.
    firings = placed.where(F.col("lateness") == LATE).drop("lateness").unionByName(first, allowMissingColumns=True)
    # Few rows remain, at the end of a long plan that the steps below would otherwise repeat.
    firings = checkpointed(firings)
    done = KeyedSequence(firings, group, order).running(fire_no=running_count(), value=running_sum("_value")).rows()
    return done.select(*group, "fire_no", "value")


def tumbling_bounded(
    df: DataFrame, keys: list[str], ts_ms: str, order: list[str], size_ms: int, delay_ms: int, **aggregates: Column
) -> DataFrame:
    """Aggregates per key and window over the rows that arrived before their window fired; later rows are dropped."""
    seen = classify(df, ts_ms, order, size_ms, size_ms, delay_ms, 0).where(F.col("lateness") == ON_TIME)
    start = floor_to(F.col(ts_ms), size_ms).alias("win_start_ms")
    return seen.groupBy(*keys, start).agg(*[c.alias(n) for n, c in aggregates.items()])


def sliding_bounded(
    df: DataFrame,
    keys: list[str],
    ts_ms: str,
    order: list[str],
    size_ms: int,
    slide_ms: int,
    delay_ms: int,
    **folds: tuple[str, Column],
) -> DataFrame:
    """As ``sliding``, but a row counts only in those of its windows that had not fired when it arrived."""
    seen = replay_watermark(df, ts_ms, order, delay_ms)
    return _open_windows(seen, keys, ts_ms, size_ms, slide_ms, 0, folds)


def _open_windows(
    seen: DataFrame, keys: list[str], ts_ms: str, size_ms: int, slide_ms: int, lateness_ms: int, folds: dict[str, tuple[str, Column]]
) -> DataFrame:
    """Sliding aggregates over the windows of each row that are open, given its watermark.

    Rows are reduced to ``(key, slide slot, oldest open window)`` before they are copied into windows; rows on time share one
    such entry per slot.
    """
    if slide_ms > size_ms:
        raise ValueError("windows must touch: slide_ms may not exceed size_ms")
    # A window is open while start + size - 1 + lateness > watermark.
    bound = F.col("wm_before") - F.lit(size_ms - 1 + lateness_ms)
    first_open = F.greatest(oldest_start(F.col(ts_ms), size_ms, slide_ms), floor_to(bound, slide_ms) + F.lit(slide_ms))
    slots = (
        seen.groupBy(*keys, floor_to(F.col(ts_ms), slide_ms).alias("_newest"), first_open.alias("_oldest"))
        .agg(*[MERGE[kind](value).alias(name) for name, (kind, value) in folds.items()])
        .where(F.col("_oldest") <= F.col("_newest"))
    )
    starts = F.explode(F.sequence("_oldest", "_newest", F.lit(slide_ms).cast("bigint"))).alias("win_start_ms")
    merged = slots.select(*keys, starts, *folds).groupBy(*keys, "win_start_ms")
    return merged.agg(*[MERGE[kind](name).alias(name) for name, (kind, _) in folds.items()])


def sliding_counts_with_late(
    df: DataFrame, keys: list[str], ts_ms: str, order: list[str], size_ms: int, slide_ms: int, delay_ms: int, lateness_ms: int
) -> tuple[DataFrame, DataFrame]:
    """(final counts ``keys, win_start_ms, cnt`` of sliding windows, rows that came too late for all their windows).

    A late row still counts in those of its windows that are open.
    """
    seen = classify(df, ts_ms, order, size_ms, slide_ms, delay_ms, lateness_ms)
    aside = seen.where(F.col("lateness") == ASIDE).select(*df.columns)
    one = ("sum", F.lit(1).cast("bigint"))
    return _open_windows(seen, keys, ts_ms, size_ms, slide_ms, lateness_ms, {"cnt": one}), aside
