"""Windows, joins and distinct counts on streams, with Spark's own streaming operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def arrival_time(df: DataFrame, out: str = "proc_ts") -> DataFrame:
    """Add the processing time (that of the micro-batch) for windows on the machine clock."""
    return df.withColumn(out, F.current_timestamp())


def event_time(df: DataFrame, ts: str, delay: str = "0 seconds", lateness: str | None = None) -> DataFrame:
    """Declare ``ts`` the event time. ``lateness`` is added to the delay: in update mode a window is then shown early and
    refined until it closes."""
    if lateness is None:
        return df.withWatermark(ts, delay)
    both = _seconds(delay) + _seconds(lateness)
    return df.withWatermark(ts, f"{both} seconds")


def _seconds(duration: str) -> int:
    amount, unit = duration.split()
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return int(amount) * scale[unit.rstrip("s")]


def _flat(done: DataFrame, keys: list[str], aggregates: dict[str, Column], end: bool = False) -> DataFrame:
    columns = [F.unix_millis("_w.start").alias("session_start_ms" if end else "win_start_ms")]
    if end:
        columns.append(F.unix_millis("_w.end").alias("session_end_ms"))
    return done.select(*keys, *columns, *aggregates)


def windowed(
    df: DataFrame, keys: list[str], ts: str, size: str, slide: str | None = None, **aggregates: Column
) -> DataFrame:
    """Tumbling or sliding windows; no keys for one window over all rows."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    done = df.groupBy(*keys, window.alias("_w")).agg(*[c.alias(n) for n, c in aggregates.items()])
    return _flat(done, keys, aggregates)


def sessions(df: DataFrame, keys: list[str], ts: str, gap: str, **aggregates: Column) -> DataFrame:
    """Session windows; append mode only."""
    done = df.groupBy(*keys, F.session_window(ts, gap).alias("_w")).agg(*[c.alias(n) for n, c in aggregates.items()])
    return _flat(done, keys, aggregates, end=True)


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, lower: str, upper: str
) -> DataFrame:
    """Pairs with ``left_ts + lower <= right_ts <= left_ts + upper``. Both sides need a watermark; the bounds let Spark
    drop rows that can no longer find a partner. Write bounds like ``"-10 seconds"``."""
    l, r = left.alias("l"), right.alias("r")
    bounds = F.expr(
        f"r.{right_ts} >= l.{left_ts} + interval {lower} and r.{right_ts} <= l.{left_ts} + interval {upper}"
    )
    on = (F.col(f"l.{key}") == F.col(f"r.{key}")) & bounds
    rest = [F.col(f"r.{c}") for c in right.columns if c != key]
    return l.join(r, on, "inner").select("l.*", *rest)


def unmatched(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, lower: str, upper: str
) -> DataFrame:
    """Rows of ``left`` for which no partner ``left_ts + lower <= right_ts <= left_ts + upper`` has come and none can come any more.

    Both sides need a watermark. A row is reported once the watermark has passed its last possible partner, and forgotten
    then; a row whose partner came is never reported. For the other side swap the sides and the bounds. Rows without a time
    are dropped by the watermark.
    """
    l = left.select(F.struct(*left.columns).alias("_row"), F.col(key).alias("_lk"), F.col(left_ts).alias("_lt"))
    r = right.select(F.col(key).alias("_rk"), F.col(right_ts).alias("_rt"))
    bounds = F.expr(f"_rt >= _lt + interval {lower} and _rt <= _lt + interval {upper}")
    return l.join(r, (F.col("_lk") == F.col("_rk")) & bounds, "left_outer").where("_rt is null").select("_row.*")


def first_seen(df: DataFrame, keys: list[str], within_watermark: bool = False) -> DataFrame:
    """First row per key. ``within_watermark`` forgets keys once the watermark has passed, which bounds the state."""
    return df.dropDuplicatesWithinWatermark(keys) if within_watermark else df.dropDuplicates(keys)


def distinct_count(df: DataFrame, keys: list[str], out: str = "uv") -> DataFrame:
    """Number of distinct keys so far; update or complete mode."""
    return first_seen(df.select(*keys), keys).groupBy().agg(F.count(F.lit(1)).alias(out))
