"""Time, session and count windows. Window starts are epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater import operators as op
from tidewater.functions import exact_sum
from tidewater.functions.scalars import exact_units, exact_value
from tidewater.operators.windows import floor_to, millis
from tidewater.plans.registry import query

HOUR = 3_600_000


def _sensor(t):
    return t.events.select("user_id", "event_id", "ts", "value")


def _tumbling_sql(width: int, *, key: str = "user_id, ", extra: str = "") -> str:
    return f"""
    select {key}epoch_us(ts) // 1000 // {width} * {width} as win_start_ms{extra}
    from events group by all
    """


_SUM = ", sum(cast(value as decimal(18, 2)))::double as total"


@query(
    _tumbling_sql(
        6 * HOUR, extra=_SUM + ", epoch_us(arg_min(ts, event_id)) // 1000 as first_ms"
    )
)
def tumbling_sum(t):
    return op.tumbling(
        _sensor(t),
        ["user_id"],
        "ts",
        "6 hours",
        total=exact_sum("value"),
        first_ms=F.unix_millis(F.min_by("ts", "event_id")),
    )


def _sliding_sql(size: int, slide: int) -> str:
    return f"""
    select user_id, epoch_us(ts) // 1000 // {slide} * {slide} - i * {slide} as win_start_ms,
           sum(cast(value as decimal(18, 2)))::double as total, count(*) as n
    from events, range({size // slide}) r(i)
    group by all
    """


def _sliding(t, size, slide):
    done = op.sliding(
        _sensor(t), ["user_id"], "ts", size, slide,
        units=("sum", exact_units("value")), n=("sum", F.lit(1).cast("bigint")),
    )
    return done.select("user_id", "win_start_ms", exact_value(F.col("units")).alias("total"), "n")


@query(_sliding_sql(6 * HOUR, 2 * HOUR))
def sliding_sum(t):
    return _sliding(t, 6 * HOUR, 2 * HOUR)


def _session_sql(gap: int) -> str:
    return f"""
    with marked as (
        select *, case when epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts, event_id)
                  <= {gap * 1000} then 0 else 1 end as fresh
        from events
    ), numbered as (
        select *, sum(fresh) over (partition by user_id order by ts, event_id
                                   rows between unbounded preceding and current row) as s
        from marked
    )
    select user_id, epoch_us(min(ts)) // 1000 as session_start_ms,
           (epoch_us(max(ts)) + {gap * 1000}) // 1000 as session_end_ms,
           sum(cast(value as decimal(18, 2)))::double as total, count(*) as n
    from numbered group by user_id, s
    """


@query(_session_sql(3 * HOUR))
def session_sum(t):
    return op.sessions(
        _sensor(t), ["user_id"], "ts", 3 * HOUR, total=exact_sum("value"), n=F.count(F.lit(1))
    )


@query(_session_sql(6 * HOUR))
def et_session_sum(t):
    return op.sessions(
        _sensor(t), ["user_id"], "ts", 6 * HOUR, total=exact_sum("value"), n=F.count(F.lit(1))
    )


@query(
    """
    with numbered as (select *, row_number() over (partition by user_id order by event_id) - 1 as rn from events)
    select user_id, rn // 5 as block, sum(cast(value as decimal(18, 2)))::double as total, min(event_id) as first_id
    from numbered group by user_id, rn // 5 having count(*) = 5
    """
)
def count_tumbling(t):
    return op.count_tumbling(
        _sensor(t), ["user_id"], "event_id", 5, total=exact_sum("value"), first_id=F.min("event_id")
    )


@query(
    """
    select user_id, event_id, total from (
        select user_id, event_id,
               sum(cast(value as decimal(18, 2))) over (
                   partition by user_id order by event_id rows between 4 preceding and current row)::double as total,
               row_number() over (partition by user_id order by event_id) as rn
        from events
    ) where rn % 2 = 0
    """
)
def count_sliding(t):
    done = op.count_sliding(_sensor(t), ["user_id"], "event_id", 5, 2, units=F.sum(exact_units("value")))
    return done.select("user_id", "event_id", exact_value(F.col("units")).alias("total"))


@query("select user_id, row_number() over (partition by user_id order by event_id) - 1 as block, cast(value as decimal(18, 2))::double as total from events")
def global_trigger_each(t):
    # A trigger that fires and purges on every row: count windows of one row.
    return op.count_tumbling(_sensor(t), ["user_id"], "event_id", 1, total=exact_sum("value"))


@query(_tumbling_sql(6 * HOUR, key="", extra=_SUM + ", arg_min(user_id, event_id) as first_user"))
def window_all_sum(t):
    return op.tumbling(
        _sensor(t), [], "ts", "6 hours", total=exact_sum("value"), first_user=F.min_by("user_id", "event_id")
    )


@query(_tumbling_sql(3 * HOUR, extra=", count(*) as n"))
def window_apply_count(t):
    return op.tumbling(_sensor(t), ["user_id"], "ts", "3 hours", n=F.count(F.lit(1)))


@query(_tumbling_sql(5 * HOUR, extra=_SUM))
def window_reduce_with_start(t):
    return op.tumbling(_sensor(t), ["user_id"], "ts", "5 hours", total=exact_sum("value"))


@query(_tumbling_sql(5 * HOUR, extra=", sum(1)::bigint as n, max(value) as top"))
def window_agg_with_start(t):
    return op.tumbling(
        _sensor(t), ["user_id"], "ts", "5 hours", n=F.sum(F.lit(1).cast("bigint")), top=F.max("value")
    )


class _Low(op.Aggregator):
    """Count, and the smallest value with the number of rows that hold it."""

    schema = "n bigint, low double, times bigint"
    columns = ["value"]

    def partial(self, groups):
        low = groups["value"].transform("min")
        rows = groups.obj.assign(times=(groups.obj["value"] == low).astype("int64"))
        return rows.groupby(groups.keys, dropna=False, sort=False).agg(n=("value", "size"), low=("value", "min"), times=("times", "sum"))

    def merge(self, groups):
        low = groups["low"].transform("min")
        rows = groups.obj.assign(times=groups.obj["times"].where(groups.obj["low"] == low, 0))
        return rows.groupby(groups.keys, dropna=False, sort=False).agg(n=("n", "sum"), low=("low", "min"), times=("times", "sum"))


_LOWS = f"""
    with placed as (select user_id % 4 as k, epoch_us(ts) // 1000 // {6 * HOUR} * {6 * HOUR} as win_start_ms, floor(value / 50) as value from events)
    select k, win_start_ms, count(*) as n, min(value) as low, count(*) filter (value = low_of) as times
    from (select *, min(value) over (partition by k, win_start_ms) as low_of from placed) group by k, win_start_ms
    """


@query(_LOWS)
def window_process_udf(t):
    placed = t.events.select(
        (F.col("user_id") % 4).alias("k"), floor_to(millis("ts"), 6 * HOUR).alias("win_start_ms"), F.floor(F.col("value") / 50).cast("double").alias("value")
    )
    return op.aggregate_with(placed, ["k", "win_start_ms"], _Low())


@query(
    f"""
    with placed as (
        select user_id, event_id, value, epoch_us(ts) // 1000 // {48 * HOUR} * {48 * HOUR} as win_start_ms from events
    ), judged as (
        select *, value > lag(value) over w and value > lead(value) over w as peak from placed
        window w as (partition by user_id, win_start_ms order by event_id)
    )
    select user_id, win_start_ms, count(*) filter (peak) as peaks, coalesce(min(event_id) filter (peak), -1) as first_peak
    from judged group by user_id, win_start_ms
    """
)
def window_peaks(t):
    """How many readings are above both neighbours in arrival order, and the first of them (-1: none).

    Each row judges the one before it, so two rows of look-back do and a window of any size is cut as any hot key. NULL
    ids come last, as in the SQL; a NaN is above nothing.
    """
    group = ["user_id", "win_start_ms"]
    placed = _sensor(t).select(
        "user_id", floor_to(millis("ts"), 48 * HOUR).alias("win_start_ms"), "event_id", "ts", F.nanvl("value", F.lit(None)).alias("value"),
        F.coalesce("event_id", F.lit(2**63 - 1)).alias("_at"),
    )
    judged = op.KeyedSequence(placed.where("win_start_ms is not null"), group, ["_at", "ts", "value"]).with_window(
        2,
        lambda w: {
            "_id": F.lag("event_id").over(w),
            "_peak": (F.lag("value").over(w) > F.lag("value", 2).over(w)) & (F.lag("value").over(w) > F.col("value")),
        },
    )
    return judged.rows().groupBy(*group).agg(
        F.count_if("_peak").alias("peaks"), F.coalesce(F.min(F.when(F.col("_peak"), F.col("_id"))), F.lit(-1)).alias("first_peak")
    )


def _steepest(key, start, rows):
    """The largest rise from one value to the next, and the later row's id; nothing for windows of one row."""
    before, best = None, None
    for event_id, value in rows:
        if before is not None and (best is None or value - before > best[0]):
            best = (value - before, event_id)
        before = value
    if best is not None:
        yield best


@query(
    f"""
    with placed as (
        select user_id, event_id, value, epoch_us(ts) // 1000 // {48 * HOUR} * {48 * HOUR} as win_start_ms from events
    ), risen as (
        select *, value - lag(value) over (partition by user_id, win_start_ms order by event_id) as rise from placed
    )
    select user_id, win_start_ms, max(rise) as rise, arg_max(event_id, {{'r': rise, 's': -event_id}}) as event_id
    from risen where rise is not null group by all
    """
)
def window_steepest(t):
    return op.walk_windows(_sensor(t), ["user_id"], "ts", 48 * HOUR, ["event_id"], ["event_id", "value"], _steepest, "rise double, event_id bigint")


@query(_tumbling_sql(5 * HOUR, extra=_SUM + ", count(*) as n"))
def et_tumbling_sum(t):
    return op.tumbling(
        _sensor(t), ["user_id"], "ts", "5 hours", total=exact_sum("value"), n=F.count(F.lit(1))
    )


@query(_sliding_sql(12 * HOUR, 4 * HOUR))
def et_sliding_sum(t):
    return _sliding(t, 12 * HOUR, 4 * HOUR)


@query(
    f"""
    select 'hour' as span, event_type, epoch_us(ts) // 1000 // {HOUR} * {HOUR} as win_start_ms, count(distinct user_id) as uv from events group by all
    union all
    select 'day', event_type, epoch_us(ts) // 1000 // {24 * HOUR} * {24 * HOUR}, count(distinct user_id) from events group by all
    union all
    select 'day', null, epoch_us(ts) // 1000 // {24 * HOUR} * {24 * HOUR}, count(distinct user_id) from events group by all
    """
)
def uv_rolled_up(t):
    """Distinct users per hour and type, per day and type, and per day: rows are read for the hours only."""
    rows = t.events.select("event_type", "user_id", F.unix_millis("ts").alias("ts_ms"))
    hours = op.pane_bitmaps(rows, ["event_type"], "ts_ms", "user_id", HOUR)
    days = op.roll_up(hours, ["event_type"], 24 * HOUR)
    group = ["event_type", "win_start_ms"]
    shown = [
        op.distinct_from(hours.withColumnRenamed("pane_start_ms", "win_start_ms"), group).withColumn("span", F.lit("hour")),
        op.distinct_from(days, group).withColumn("span", F.lit("day")),
        op.distinct_from(op.merge_bitmaps(days, ["win_start_ms"]), ["win_start_ms"]).withColumn("span", F.lit("day")),
    ]
    return shown[0].unionByName(shown[1]).unionByName(shown[2], allowMissingColumns=True)


@query(
    f"""
    select ts_ms // {HOUR} * {HOUR} - i * {HOUR} as win_start_ms, count(distinct props) as n_props
    from (select epoch_us(ts) // 1000 as ts_ms, props from events), range(6) r(i) group by all having count(distinct props) > 0
    """
)
def distinct_props_sliding(t):
    """Distinct strings in sliding windows: numbered once, then as bitmaps of hours."""
    rows = op.dense_ids(t.events.select("props", F.unix_millis("ts").alias("ts_ms")), "props", "number")
    hours = op.pane_bitmaps(rows, [], "ts_ms", "number", HOUR)
    return op.distinct_from(op.roll_up(hours, [], 6 * HOUR, HOUR), ["win_start_ms"], "n_props")
