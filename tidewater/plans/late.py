"""Watermark replay and late rows over an arrival order that differs from time order."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater import operators as op
from tidewater.functions.scalars import exact_units, exact_value
from tidewater.plans.registry import query

MINUTE = 60_000
HOUR = 60 * MINUTE
_NO_WATERMARK = -(2**63)

_SEEN = f"""
    arrivals as (
        select event_id, user_id, value, epoch_us(ts) // 1000 as ts_ms, event_id + (event_id * 7919) % 50 as arrival from events
    ), seen as (
        select *, max(ts_ms) over (order by arrival, event_id rows between unbounded preceding and 1 preceding)
                  - {HOUR} - 1 as wm_before
        from arrivals
    )
"""


def _arrivals(t):
    arrival = F.col("event_id") + (F.col("event_id") * 7919) % 50
    return t.events.select(
        "event_id", "user_id", "value", F.unix_millis("ts").alias("ts_ms"), arrival.alias("arrival")
    )


_ORDER = ["arrival", "event_id"]


@query(f"with {_SEEN} select event_id, ts_ms, coalesce(wm_before, {_NO_WATERMARK}) as wm_before from seen")
def watermark_replay(t):
    rows = _arrivals(t).select("event_id", "ts_ms", "arrival")
    return op.replay_watermark(rows, "ts_ms", _ORDER, HOUR).select(
        "event_id", "ts_ms", F.coalesce("wm_before", F.lit(_NO_WATERMARK)).alias("wm_before")
    )


def _class_sql(start: str, size: int, lateness: int) -> str:
    last = f"{start} + {size - 1}"
    return f"""case when wm_before is null or {last} > wm_before then 'on_time'
                    when {last} + {lateness} > wm_before then 'late_accepted' else 'side_output' end"""


@query(
    f"""
    with {_SEEN}
    select event_id, user_id, ts_ms // {HOUR} * {HOUR} as win_start_ms,
           {_class_sql(f"ts_ms // {HOUR} * {HOUR}", HOUR, 30 * MINUTE)} as lateness
    from seen
    """
)
def late_side_output(t):
    seen = op.classify(_arrivals(t), "ts_ms", _ORDER, HOUR, HOUR, HOUR, 30 * MINUTE)
    start = F.col("ts_ms") - F.pmod("ts_ms", F.lit(HOUR))
    return seen.select("event_id", "user_id", start.alias("win_start_ms"), "lateness")


@query(
    f"""
    with {_SEEN}, placed as (
        select *, ts_ms // {6 * HOUR} * {6 * HOUR} as win_start_ms,
               {_class_sql(f"ts_ms // {6 * HOUR} * {6 * HOUR}", 6 * HOUR, 30 * MINUTE)} as lateness
        from seen
    ), totals as (
        select *, sum(cast(value as decimal(18, 2))) over w::double as total,
               count(*) filter (where lateness = 'late_accepted') over w as n_late,
               count(*) filter (where lateness = 'on_time') over (partition by win_start_ms) as n_on_time,
               row_number() over w as rn
        from placed where lateness <> 'side_output'
        window w as (partition by win_start_ms order by arrival, event_id
                     rows between unbounded preceding and current row)
    )
    select win_start_ms, n_late + case when n_on_time > 0 then 1 else 0 end as fire_no, total as value
    from totals where lateness = 'late_accepted' or rn = n_on_time
    """
)
def late_updates(t):
    done = op.late_updates(
        _arrivals(t), [], "ts_ms", _ORDER, 6 * HOUR, HOUR, 30 * MINUTE, exact_units("value")
    )
    return done.select("win_start_ms", "fire_no", exact_value(F.col("value")).alias("value"))


@query(
    f"""
    with {_SEEN}, placed as (
        select user_id, wm_before, ts_ms // {HOUR} * {HOUR} - i * {HOUR} as win_start_ms from seen, range(6) r(i)
    )
    select user_id, win_start_ms, count(*) as cnt
    from placed
    where wm_before is null or win_start_ms + {6 * HOUR - 1} + {30 * MINUTE} > wm_before
    group by all
    """
)
def sliding_count_late(t):
    counts, _ = op.sliding_counts_with_late(
        _arrivals(t).select("event_id", "user_id", "ts_ms", "arrival"),
        ["user_id"], "ts_ms", _ORDER, 6 * HOUR, HOUR, HOUR, 30 * MINUTE,
    )
    return counts


@query(
    f"""
    with {_SEEN}
    select event_id, user_id, ts_ms from seen
    where {_class_sql(f"ts_ms // {HOUR // 2} * {HOUR // 2}", HOUR, 30 * MINUTE)} = 'side_output'
    """
)
def sliding_late_aside(t):
    _, aside = op.sliding_counts_with_late(
        _arrivals(t).select("event_id", "user_id", "ts_ms", "arrival"),
        ["user_id"], "ts_ms", _ORDER, HOUR, HOUR // 2, HOUR, 30 * MINUTE,
    )
    return aside.select("event_id", "user_id", "ts_ms")


@query(
    f"""
    with {_SEEN}, placed as (
        select *, ts_ms // {HOUR} * {HOUR} - i * {HOUR} as win_start_ms from seen, range(3) r(i)
    ), judged as (
        select *, {_class_sql("win_start_ms", 3 * HOUR, 30 * MINUTE)} as lateness from placed
    ), totals as (
        select *, sum(cast(value as decimal(18, 2))) over w::double as total,
               count(*) filter (where lateness = 'late_accepted') over w as n_late,
               count(*) filter (where lateness = 'on_time') over (partition by win_start_ms) as n_on_time,
               row_number() over w as rn
        from judged where lateness <> 'side_output'
        window w as (partition by win_start_ms order by (lateness <> 'on_time')::int, arrival, event_id
                     rows between unbounded preceding and current row)
    )
    select win_start_ms, n_late + case when n_on_time > 0 then 1 else 0 end as fire_no, total as value
    from totals where lateness = 'late_accepted' or rn = n_on_time
    """
)
def late_updates_sliding(t):
    done = op.late_updates(
        _arrivals(t), [], "ts_ms", _ORDER, 3 * HOUR, HOUR, 30 * MINUTE, exact_units("value"), slide_ms=HOUR
    )
    return done.select("win_start_ms", "fire_no", exact_value(F.col("value")).alias("value"))


@query(
    f"""
    with {_SEEN}
    select user_id, ts_ms // {2 * HOUR} * {2 * HOUR} as win_start_ms, sum(cast(value as decimal(18, 2)))::double as total, count(*) as n
    from seen where {_class_sql(f"ts_ms // {2 * HOUR} * {2 * HOUR}", 2 * HOUR, 0)} = 'on_time'
    group by all
    """
)
def et_tumbling_bounded(t):
    done = op.tumbling_bounded(
        _arrivals(t), ["user_id"], "ts_ms", _ORDER, 2 * HOUR, HOUR, units=F.sum(exact_units("value")), n=F.count(F.lit(1))
    )
    return done.select("user_id", "win_start_ms", exact_value(F.col("units")).alias("total"), "n")


@query(
    f"""
    with {_SEEN}, placed as (
        select *, ts_ms // {HOUR} * {HOUR} - i * {HOUR} as win_start_ms from seen, range(4) r(i)
    )
    select user_id, win_start_ms, sum(cast(value as decimal(18, 2)))::double as total, count(*) as n
    from placed where {_class_sql("win_start_ms", 4 * HOUR, 0)} = 'on_time'
    group by all
    """
)
def et_sliding_bounded(t):
    done = op.sliding_bounded(
        _arrivals(t), ["user_id"], "ts_ms", _ORDER, 4 * HOUR, HOUR, HOUR,
        units=("sum", exact_units("value")), n=("sum", F.lit(1).cast("bigint")),
    )
    return done.select("user_id", "win_start_ms", exact_value(F.col("units")).alias("total"), "n")


def _session_walk(gap: int, lateness: int) -> str:
    """Row by row per user: the open sessions as a list, what each row makes fire, and whether it was dropped."""
    end = f"{gap - 1}"
    return f"""
    with recursive {_SEEN}, numbered as (
        select *, row_number() over (partition by user_id order by arrival, event_id) as rn,
               count(*) over (partition by user_id) as last_rn
        from seen
    ), walk as (
        select user_id, 0::bigint as rn, 0::bigint as event_id, 0::bigint as at_ms, false as dropped,
               []::struct(s bigint, e bigint, f boolean, n bigint, units bigint)[] as open,
               []::struct(s bigint, e bigint, f boolean, n bigint, units bigint)[] as fired
        from (select distinct user_id from seen)
        union all
        select user_id, rn, event_id, ts_ms, dropped,
               case when dropped then rest else list_append(rest, merged) end,
               list_concat(due, case when now then [merged] else [] end)
        from (
            select *, not dropped and coalesce(merged.e + {end} <= wm_before, false) as now
            from (
                select *, len(met) = 0 and coalesce(ts_ms + {end} + {lateness} <= wm_before, false) as dropped,
                       struct_pack(
                           s := least(ts_ms, list_min(list_transform(met, lambda x: x.s))),
                           e := greatest(ts_ms, list_max(list_transform(met, lambda x: x.e))),
                           f := coalesce(greatest(ts_ms, list_max(list_transform(met, lambda x: x.e))) + {end} <= wm_before, false),
                           n := 1 + coalesce(list_sum(list_transform(met, lambda x: x.n)), 0)::bigint,
                           units := (value_units + coalesce(list_sum(list_transform(met, lambda x: x.units)), 0))::bigint
                       ) as merged
                from (
                    select *, list_filter(held, lambda x: x.s <= ts_ms + {gap} and x.e + {gap} >= ts_ms) as met,
                           list_filter(held, lambda x: not (x.s <= ts_ms + {gap} and x.e + {gap} >= ts_ms)) as rest
                    from (
                        select n.user_id, n.rn, n.event_id, n.ts_ms, n.wm_before, round(n.value * 100)::bigint as value_units,
                               list_filter(w.open, lambda x: not x.f and coalesce(x.e + {end} <= n.wm_before, false)) as due,
                               list_transform(
                                   list_filter(w.open, lambda x: coalesce(x.e + {end} + {lateness} > n.wm_before, true)),
                                   lambda x: struct_pack(s := x.s, e := x.e, f := x.f or coalesce(x.e + {end} <= n.wm_before, false), n := x.n, units := x.units)
                               ) as held
                        from walk w join numbered n on n.user_id = w.user_id and n.rn = w.rn + 1
                    )
                )
            )
        )
    ), fires as (
        select user_id, unnest(fired) as x from walk
        union all
        select w.user_id, unnest(list_filter(w.open, lambda x: not x.f)) as x
        from walk w join numbered n on n.user_id = w.user_id and n.rn = w.rn and n.rn = n.last_rn
    )
    """


_FIRES = f"select user_id, x.s as session_start_ms, x.e + {2 * HOUR} as session_end_ms, x.n as n, x.units / 100.0::double as total from fires"


def _sessions(t, lateness: int):
    return op.merging_sessions(
        _arrivals(t), ["user_id"], "ts_ms", _ORDER, 2 * HOUR, HOUR, lateness, n=("sum", F.lit(1).cast("bigint")), units=("sum", exact_units("value"))
    )


def _shown(firings):
    return firings.select("user_id", "session_start_ms", "session_end_ms", "n", exact_value(F.col("units")).alias("total"))


@query(_session_walk(2 * HOUR, 0) + _FIRES)
def et_session_bounded(t):
    return _shown(_sessions(t, 0)[0])


@query(_session_walk(2 * HOUR, HOUR // 2) + _FIRES)
def session_updates(t):
    """Every firing of merging sessions: the first, re-firings with late rows, sessions bridged after they had fired."""
    return _shown(_sessions(t, HOUR // 2)[0])


@query(_session_walk(2 * HOUR, HOUR // 2) + "select user_id, event_id, at_ms as ts_ms from walk where dropped")
def session_late_aside(t):
    return _sessions(t, HOUR // 2)[1].select("user_id", "event_id", "ts_ms")
