"""Time, session and count windows over tables. Time windows are aligned to the epoch and are ``[start, end)``."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.ordered import KeyedSequence, hot_keys, running_count, running_max

MERGE = {"sum": F.sum, "max": F.max, "min": F.min}


def millis(ts: Column | str) -> Column:
    return F.unix_millis(F.col(ts) if isinstance(ts, str) else ts)


def floor_to(value: Column, step: int) -> Column:
    """The greatest multiple of ``step`` that is not above ``value``."""
    return value - F.pmod(value, F.lit(step))


def tumbling(df: DataFrame, keys: list[str], ts: str, width: str, **aggregates: Column) -> DataFrame:
    """Aggregates per key and window; ``win_start_ms`` is the window start in epoch milliseconds."""
    done = df.groupBy(*keys, F.window(ts, width).alias("_w")).agg(*[c.alias(n) for n, c in aggregates.items()])
    return done.select(*keys, F.unix_millis("_w.start").alias("win_start_ms"), *aggregates)


def sliding(
    df: DataFrame, keys: list[str], ts: str, size_ms: int, slide_ms: int, **folds: tuple[str, Column]
) -> DataFrame:
    """Sliding aggregates given as ``name=(kind, value)`` with kind sum, max or min.

    Rows are first reduced to panes (the common divisor of size and slide); only panes are copied into the windows
    that cover them, not every row ``size / slide`` times.
    """
    pane = gcd(size_ms, slide_ms)
    panes = (
        df.groupBy(*keys, floor_to(millis(ts), pane).alias("_pane"))
        .agg(*[MERGE[kind](value).alias(name) for name, (kind, value) in folds.items()])
        .where(F.col("_pane").isNotNull())
    )
    covering = window_starts(F.col("_pane"), size_ms, slide_ms)
    return (
        panes.select(*keys, F.explode(covering).alias("win_start_ms"), *folds)
        .groupBy(*keys, "win_start_ms")
        .agg(*[MERGE[kind](name).alias(name) for name, (kind, _) in folds.items()])
    )


def window_starts(at_ms: Column, size_ms: int, slide_ms: int) -> Column:
    """Starts of all sliding windows that contain the instant, oldest first; NULL if none does (slide above size)."""
    oldest, newest = oldest_start(at_ms, size_ms, slide_ms), floor_to(at_ms, slide_ms)
    return F.when(oldest <= newest, F.sequence(oldest, newest, F.lit(slide_ms).cast("bigint")))


def oldest_start(at_ms: Column, size_ms: int, slide_ms: int) -> Column:
    return floor_to(at_ms - F.lit(size_ms), slide_ms) + F.lit(slide_ms)


def sessions(df: DataFrame, keys: list[str], ts: str, gap_ms: int, **aggregates: Column) -> DataFrame:
    """Aggregates per session: rows of a key join while they are at most ``gap_ms`` apart. The session is
    ``[first, last + gap)``.

    ``F.session_window`` would send every row of a key to one task; here only the session starts depend on order, and
    the sequence takes care of hot keys. The aggregation itself is an ordinary one.
    """
    data = df.where(F.col(ts).isNotNull()).withColumn("_us", F.unix_micros(ts))
    marked = mark_sessions(data, keys, gap_ms)
    done = marked.groupBy(*keys, "_start").agg(
        F.max("_us").alias("_last"), *[c.alias(n) for n, c in aggregates.items()]
    )
    return done.select(
        *keys,
        F.unix_millis(F.timestamp_micros("_start")).alias("session_start_ms"),
        F.unix_millis(F.timestamp_micros(F.col("_last") + gap_ms * 1000)).alias("session_end_ms"),
        *aggregates,
    )


def mark_sessions(data: DataFrame, keys: list[str], gap_ms: int) -> DataFrame:
    """Rows with ``_start``, the first instant (``_us``) of their session."""
    if keys and hot_keys(data, keys) is None:
        return _mark_sessions(data, keys, gap_ms, known_cold=True)
    # Any number of rows may share an instant, so order the distinct instants and bring the result back.
    instants = data.select(*keys, "_us").distinct()
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    starts = _mark_sessions(instants, keys, gap_ms).withColumnsRenamed({**names, "_us": "_at"})
    same = [F.col("_us") == F.col("_at"), *[F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]]
    return data.join(starts, same, "inner").drop("_at", *names.values())


def _mark_sessions(data: DataFrame, keys: list[str], gap_ms: int, known_cold: bool = False) -> DataFrame:
    """Add ``_start``, the first instant of the row's session."""
    starts = F.when(F.col("_prev").isNull() | (F.col("_us") - F.col("_prev") > gap_ms * 1000), F.col("_us"))
    return (
        KeyedSequence(data, keys, ["_us"], known_cold)
        .with_window(1, lambda w: {"_prev": F.lag("_us", 1).over(w)})
        .running(_start=running_max(starts))
        .rows()
        .drop("_prev")
    )


def count_tumbling(df: DataFrame, keys: list[str], seq: str, size: int, **aggregates: Column) -> DataFrame:
    """Aggregates over each full block of ``size`` rows of a key; an unfinished block gives nothing."""
    numbered = KeyedSequence(df, keys, [seq]).running(_n=running_count()).rows()
    return (
        numbered.groupBy(*keys, F.expr(f"(_n - 1) div {size}").alias("block"))
        .agg(F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in aggregates.items()])
        .where(F.col("_rows") == size)
        .drop("_rows")
    )


def count_sliding(
    df: DataFrame, keys: list[str], seq: str, size: int, slide: int, **aggregates: Column
) -> DataFrame:
    """On every ``slide``-th row of a key, aggregates over its last ``size`` rows (fewer at the beginning)."""
    return (
        KeyedSequence(df, keys, [seq])
        .running(_n=running_count())
        .with_window(
            max(size - 1, 1),
            lambda w: {name: c.over(w.rowsBetween(1 - size, 0)) for name, c in aggregates.items()},
        )
        .where(F.col("_n") % slide == 0)
        .rows()
        .drop("_n")
    )
