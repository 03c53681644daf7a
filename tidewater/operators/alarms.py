"""Alarms that depend on earlier rows of the same key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.ordered import KeyedSequence
from tidewater.operators.pointers import timer_path
from tidewater.session import checkpointed, setting


def jump_alarm(df: DataFrame, keys: list[str], order: list[str], value: str, limit: float) -> DataFrame:
    """Rows whose value differs from the key's previous value by ``limit`` or more, with that value in ``previous``."""
    return (
        KeyedSequence(df, keys, order)
        .with_window(1, lambda w: {"previous": F.lag(value, 1).over(w)})
        .where(F.abs(F.col(value) - F.col("previous")) >= limit)
        .rows()
    )


def timer_fires(df: DataFrame, keys: list[str], ts: str, after_ms: int) -> DataFrame:
    """When an event-time timer set ``after_ms`` after every row fires; equal timers of a key fire once."""
    fires = (F.unix_millis(ts) + F.lit(after_ms)).alias("fire_ms")
    return df.where(F.col(ts).isNotNull()).select(*keys, fires).distinct()


def no_drop_alarm(df: DataFrame, keys: list[str], ts: str, seq: str, value: str, wait_ms: int) -> DataFrame:
    """``keys, alarm_us``: moments at which a key's value had not dropped below its baseline for ``wait_ms``.

    Per key, in time order: without a running timer, a value at or above the baseline (or the first value) starts a
    timer and becomes the baseline. A value below the baseline becomes the baseline and stops the timer. An expired
    timer is an alarm; the baseline stays.

    A key of up to ``FOLD`` rows is folded in one go. The timers of larger keys are found by pointers from timer to timer
    (``pointers``), which no single task follows row by row, rising values included.
    """
    wait = wait_ms * 1000
    data = df.where(F.col(ts).isNotNull() & F.col(value).isNotNull()).select(
        *keys, ts, F.unix_micros(ts).alias("_us"), F.col(seq).cast("bigint").alias("_seq"), F.col(value).cast("double").alias("_v")
    )
    least = min(FOLD, setting(df.sparkSession, "hotRows", 1_000_000))
    large = data.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > least).drop("_n")
    if not large.take(1):
        return _folded(data, keys, wait)
    names = {k: f"_own_{i}" for i, k in enumerate(keys)}
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()] or F.lit(True)
    large = checkpointed(large.withColumn("key", F.monotonically_increasing_id())).withColumnsRenamed(names)
    path = timer_path(data.join(large, same).select("key", F.col(ts).alias("ts"), "_us", "_seq", "_v"), wait)
    named = path.join(large, "key").select(*[F.col(n).alias(k) for k, n in names.items()], "alarm_us")
    return _folded(data.join(large, same, "left_anti"), keys, wait).unionByName(named)


#: Rows of a key that are folded as one array.
FOLD = 4096


def _folded(data: DataFrame, keys: list[str], wait: int) -> DataFrame:
    listed = data.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_us", "_seq", "_v"))).alias("_rows"))
    start = F.struct(
        F.lit(None).cast("double").alias("baseline"), F.lit(None).cast("bigint").alias("timer"), F.array().cast("array<bigint>").alias("alarms")
    )

    def step(held: Column, row: Column) -> Column:
        expired = F.coalesce(held["timer"] <= row["_us"], F.lit(False))
        drop = F.coalesce(row["_v"] < held["baseline"], F.lit(False))
        running = held["timer"].isNotNull() & ~expired
        return F.struct(
            F.when(running & ~drop, held["baseline"]).otherwise(row["_v"]).alias("baseline"),
            F.when(drop, F.lit(None)).when(running, held["timer"]).otherwise(row["_us"] + F.lit(wait)).alias("timer"),
            F.when(expired, F.concat(held["alarms"], F.array(held["timer"]))).otherwise(held["alarms"]).alias("alarms"),
        )

    def end(held: Column) -> Column:
        return F.when(held["timer"].isNotNull(), F.concat(held["alarms"], F.array(held["timer"]))).otherwise(held["alarms"])

    return listed.select(*keys, F.explode(F.aggregate("_rows", start, step, end)).alias("alarm_us"))
