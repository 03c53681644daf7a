"""Patterns of consecutive events per user, in time order."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater import operators as op
from tidewater.plans.registry import query

HOUR = 3_600_000


def _rows(t):
    return t.events.select("user_id", "event_id", "event_type", "ts")


def _is(kind):
    return F.col("event_type") == kind


def _found(matches):
    return matches.select(
        "user_id", F.unix_millis("first_ts").alias("first_ms"), F.unix_millis("last_ts").alias("last_ms")
    )


@query(
    f"""
    select user_id, epoch_us(t2) // 1000 as first_ms, epoch_us(ts) // 1000 as last_ms from (
        select user_id, ts, event_type, lag(event_type, 1) over w as e1, lag(event_type, 2) over w as e2, lag(ts, 2) over w as t2
        from events window w as (partition by user_id order by ts, event_id)
    ) where event_type = 'error' and e1 = 'error' and e2 = 'error' and epoch_us(ts) - epoch_us(t2) < {24 * HOUR * 1000}
    """
)
def match_strict(t):
    return _found(op.match_times(_rows(t), ["user_id"], ["ts", "event_id"], "ts", _is("error"), 3, 24 * HOUR))


@query(
    f"""
    select user_id, epoch_us(t2) // 1000 as first_ms, epoch_us(ts) // 1000 as last_ms from (
        select user_id, ts, lag(ts, 2) over (partition by user_id order by ts, event_id) as t2
        from events where event_type = 'error'
    ) where epoch_us(ts) - epoch_us(t2) < {24 * HOUR * 1000}
    """
)
def match_relaxed(t):
    return _found(
        op.match_times(_rows(t), ["user_id"], ["ts", "event_id"], "ts", _is("error"), 3, 24 * HOUR, consecutive=False)
    )


@query(
    f"""
    select user_id, epoch_us(t1) // 1000 as first_ms, epoch_us(ts) // 1000 as last_ms from (
        select user_id, ts, event_type, lag(event_type) over w as e1, lag(ts) over w as t1
        from events window w as (partition by user_id order by ts, event_id)
    ) where event_type = 'purchase' and e1 = 'click' and epoch_us(ts) - epoch_us(t1) < {24 * HOUR * 1000}
    """
)
def match_sequence(t):
    steps = [_is("click"), _is("purchase")]
    return _found(op.match_sequence(_rows(t), ["user_id"], ["ts", "event_id"], "ts", steps, 24 * HOUR))


_CHAINS = f"""
    numbered as (
        select user_id, epoch_us(ts) as us, event_type, row_number() over (partition by user_id order by ts, event_id) as rn from events
    ), ahead as (
        select *, min(case when event_type = 'purchase' then rn end) over w as purchase, min(case when event_type = 'error' then rn end) over w as error
        from numbered window w as (partition by user_id order by rn rows between 1 following and unbounded following)
    ), matches as (
        select a.user_id, a.rn, c.rn as last_rn, a.us // 1000 as first_ms, c.us // 1000 as last_ms
        from ahead a join ahead b on a.user_id = b.user_id and a.purchase = b.rn join ahead c on b.user_id = c.user_id and b.error = c.rn
        where a.event_type = 'click' and c.us - a.us < {48 * HOUR * 1000}
    )
"""


def _chains(t, skip):
    steps = [_is("click"), _is("purchase"), _is("error")]
    return _found(op.match_relaxed_sequence(_rows(t), ["user_id"], ["ts", "event_id"], "ts", steps, 48 * HOUR, skip))


@query(f"with {_CHAINS} select user_id, first_ms, last_ms from matches")
def match_relaxed_sequence(t):
    return _chains(t, "none")


@query(
    f"""
    with recursive {_CHAINS}, taken as (
        select user_id, min(rn) as rn from matches group by user_id
        union all
        select t.user_id, (select min(n.rn) from matches n where n.user_id = t.user_id and n.rn > m.last_rn)
        from taken t join matches m on m.user_id = t.user_id and m.rn = t.rn
    )
    select user_id, first_ms, last_ms from taken join matches using (user_id, rn)
    """
)
def match_relaxed_past_last(t):
    return _chains(t, "past_last")
