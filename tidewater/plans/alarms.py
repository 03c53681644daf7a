"""Timers, alarms, top lists, first-wins dedup and the retract log."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater import operators as op
from tidewater.operators.ordered import KeyedSequence
from tidewater.plans.registry import query

HOUR = 3_600_000


@query(f"select distinct user_id, epoch_us(ts) // 1000 + {HOUR} as fire_ms from events")
def event_timer_fires(t):
    return op.timer_fires(t.events, ["user_id"], "ts", HOUR)


@query(
    """
    select user_id, event_id, value, previous from (
        select user_id, event_id, value, lag(value) over (partition by user_id order by event_id) as previous from events
    ) where abs(value - previous) >= 10
    """
)
def jump_alarm(t):
    return op.jump_alarm(t.events.select("user_id", "event_id", "value"), ["user_id"], ["event_id"], "value", 10.0)


@query(
    f"""
    with recursive numbered as (
        select user_id, epoch_us(ts) as us, value as v,
               row_number() over (partition by user_id order by ts, event_id) as rn
        from events
    ), walk as (
        select user_id, rn, us, v as baseline, us + {12 * HOUR * 1000} as timer, cast(null as bigint) as alarm_us
        from numbered where rn = 1
        union all
        select n.user_id, n.rn, n.us,
               case when n.v < w.baseline or w.timer is null or w.timer <= n.us then n.v else w.baseline end,
               case when n.v < w.baseline then null
                    when w.timer is null or w.timer <= n.us then n.us + {12 * HOUR * 1000}
                    else w.timer end,
               case when w.timer <= n.us then w.timer end
        from walk w join numbered n on n.user_id = w.user_id and n.rn = w.rn + 1
    )
    select user_id, alarm_us from walk where alarm_us is not null
    union all
    select user_id, timer from walk
    where timer is not null and rn = (select max(rn) from numbered n where n.user_id = walk.user_id)
    """
)
def no_drop_alarm(t):
    rows = t.events.select("user_id", "ts", "event_id", "value")
    return op.no_drop_alarm(rows, ["user_id"], "ts", "event_id", "value", 12 * HOUR)


@query(
    """
    select user_id, rank, event_id, value from (
        select user_id, event_id, value, row_number() over (partition by user_id order by value desc, event_id) as rank
        from events
    ) where rank <= 3
    """
)
def topn_final(t):
    best = Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id")
    ranked = t.events.select("user_id", "event_id", "value").withColumn("rank", F.row_number().over(best).cast("bigint"))
    return ranked.where(F.col("rank") <= 3)


@query(
    """
    with numbered as (
        select user_id, event_id, value, row_number() over (partition by user_id order by event_id) as rn from events
    ), held as (
        select a.user_id, a.event_id, b.value, b.event_id as top_id,
               row_number() over (partition by a.user_id, a.event_id order by b.value desc, b.event_id) as rank
        from numbered a join numbered b on a.user_id = b.user_id and b.rn <= a.rn
    )
    select user_id, event_id, rank, top_id, value as top_value from held where rank <= 3
    """
)
def topn_running(t):
    rows = t.events.select("user_id", "event_id", "value")
    listed = KeyedSequence(rows, ["user_id"], ["event_id"]).running_top(3, "value", "event_id", "best").rows()
    return listed.select("user_id", "event_id", F.posexplode("best").alias("place", "entry")).select(
        "user_id",
        "event_id",
        (F.col("place") + 1).cast("bigint").alias("rank"),
        (-F.col("entry.neg_seq")).alias("top_id"),
        F.col("entry.value").alias("top_value"),
    )


@query("select user_id, value, min(event_id) as event_id, arg_min(event_type, event_id) as event_type from events group by user_id, value")
def dedup_first(t):
    rows = t.events.select("user_id", "value", "event_id", "event_type")
    return op.distinct_first(rows, ["user_id", "value"], ["event_id"])


@query(
    """
    with counted as (
        select user_id, event_id, row_number() over (partition by user_id order by event_id) as n from events
    )
    select true as is_add, user_id, event_id, n as cnt from counted
    union all select false, user_id, event_id, n - 1 from counted where n > 1
    """
)
def retract_changelog(t):
    return op.retract_count(t.events, ["user_id"], ["event_id"])


@query(
    """
    select user_id % 7 as team, count(*) as n, sum(cnt)::bigint as total, min(cnt) as low, max(cnt) as high
    from (select user_id, count(*) as cnt from events group by user_id) group by all
    """
)
def changelog_aggregate(t):
    """Aggregates over the counts of all users of a team, from the log in which every count is withdrawn and replaced."""
    log = op.retract_count(t.events, ["user_id"], ["event_id"]).withColumn("team", F.col("user_id") % 7)
    return op.aggregate_changelog(log, ["team"], "cnt")
