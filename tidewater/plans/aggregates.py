"""Keyed and global aggregates, final and running, and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater import operators as op
from tidewater.functions import exact_sum, split_words
from tidewater.functions.scalars import exact_units, exact_value
from tidewater.operators.ordered import KeyedSequence, hot_share, running_count, running_sum
from tidewater.plans.registry import query
from tidewater.plans.rows import _WORDS


def _tokens(t, position=None):
    return op.words(t.documents.select("doc_id", F.col("text").alias("value")), position=position)


def _by_user(t):
    return t.events.select("user_id", "event_id", "value")


@query(f"with {_WORDS} select word, count(*) as n from words group by word")
def word_count(t):
    return _tokens(t).groupBy("word").agg(F.sum(F.lit(1).cast("bigint")).alias("n"))


@query(
    f"""
    with {_WORDS}
    select doc_id, pos::bigint as pos, word, row_number() over (partition by word order by doc_id, pos) as n from words
    """
)
def word_count_running(t):
    tokens = _tokens(t, "pos")
    some = t.documents.sample(hot_share(t.spark), seed=7).select(F.col("text").alias("value"))
    sequence = KeyedSequence(tokens, ["word"], ["doc_id", "pos"], looked_at=op.words(some).select("word"))
    counted = sequence.running(n=running_count()).rows()
    return counted.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "word", "n")


@query(
    """
    select user_id, max(value) as value, arg_min(event_type, event_id) as event_type, min(event_id) as event_id
    from events group by user_id
    """
)
def max_field(t):
    rows = t.events.select("user_id", "value", "event_type", "event_id")
    return op.max_field(rows, ["user_id"], "value", ["event_id"])


@query(
    """
    select user_id, event_id, max(value) over w as value, first_value(event_type) over w as event_type
    from events
    window w as (partition by user_id order by event_id rows between unbounded preceding and current row)
    """
)
def max_field_running(t):
    rows = t.events.select("user_id", "event_id", "value", "event_type")
    return op.max_field_running(rows, ["user_id"], "value", ["event_id"])


@query(
    """
    select user_id, value, event_type, event_id
    from (select *, row_number() over (partition by user_id order by value desc, event_id) as rn from events)
    where rn = 1
    """
)
def max_by_record(t):
    rows = t.events.select("user_id", "value", "event_type", "event_id")
    return op.max_record(rows, ["user_id"], "value", "event_id")


@query(
    """
    with best as (
        select user_id, event_id,
               max(struct_pack(v := value, s := -event_id, e := event_type)) over (
                   partition by user_id order by event_id rows between unbounded preceding and current row) as b
        from events
    )
    select user_id, event_id, b.v as best_value, -b.s as best_event_id, b.e as best_event_type from best
    """
)
def max_by_running(t):
    rows = t.events.select("user_id", "event_id", "value", "event_type")
    done = op.max_record_running(rows, ["user_id"], "value", "event_id")
    return done.select("user_id", "event_id", "best_value", "best_event_id", "best_event_type")


def _visit(before, row):
    """Where a user came from and went to, and what was spent on the way, in cents."""
    return {"first": before["first"], "last": row["last"], "cents": before["cents"] + row["cents"]}


@query(
    """
    select user_id, arg_min(event_type, event_id) as first, arg_max(event_type, event_id) as last,
           sum(cast(round(value * 100) as bigint))::bigint as cents
    from events group by user_id
    """
)
def keyed_reduce(t):
    rows = t.events.select(
        "user_id", "event_id", F.col("event_type").alias("first"), F.col("event_type").alias("last"), exact_units("value").alias("cents")
    )
    return op.reduce_in_order(rows, ["user_id"], ["event_id"], _visit)


_PAIRS = "(select event_id, event_type, cast(json_extract(props, '$.k') as bigint) as k from events)"


def _pairs(t):
    k = F.get_json_object("props", "$.k").cast("bigint").alias("k")
    return t.events.select("event_id", "event_type", k)


@query(f"select event_type, k, count(*) as n from {_PAIRS} group by event_type, k")
def count_by_pair(t):
    return _pairs(t).groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""
    select event_id, event_type, k, row_number() over (partition by event_type, k order by event_id) as n
    from {_PAIRS}
    """
)
def count_by_pair_running(t):
    return KeyedSequence(_pairs(t), ["event_type", "k"], ["event_id"]).running(n=running_count()).rows()


@query("select event_type, user_id % 7 as channel, count(*) as n from events group by all")
def channel_behavior_count(t):
    return t.events.groupBy("event_type", (F.col("user_id") % 7).alias("channel")).agg(F.count(F.lit(1)).alias("n"))


@query("select count(*) as pv from events where event_type = 'view'")
def pv_total(t):
    return t.events.where(F.col("event_type") == "view").agg(F.count(F.lit(1)).alias("pv"))


@query("select event_id, row_number() over (order by event_id) as pv from events where event_type = 'view'")
def pv_running(t):
    return op.ordinal(t.events.where(F.col("event_type") == "view").select("event_id"), ["event_id"], "pv")


@query("select count(distinct user_id) as uv from events where event_type = 'view'")
def uv_total(t):
    # Two plain aggregations: distinct users first, then their number.
    users = t.events.where(F.col("event_type") == "view").select("user_id").where(F.col("user_id").isNotNull())
    return users.distinct().agg(F.count(F.lit(1)).alias("uv"))


@query(
    """
    select user_id, event_id, row_number() over (order by event_id) as uv
    from (select user_id, min(event_id) as event_id from events where event_type = 'view' group by user_id)
    """
)
def uv_running(t):
    views = t.events.where(F.col("event_type") == "view").select("user_id", "event_id")
    return op.running_distinct(views, "user_id", "event_id", "uv")


@query(f"with {_WORDS} select distinct word from words")
def distinct_words(t):
    return op.distinct_first(_tokens(t).select("word"), ["word"], [])


@query(
    f"""
    with {_WORDS}, lines as (select doc_id, count(*) as n, arg_min(word, pos) as word from words group by doc_id)
    select word, sum(n)::bigint as n from lines group by word
    """
)
def first_token_weighted(t):
    tokens = t.documents.select(split_words("text").alias("tokens")).where(F.size("tokens") > 0)
    weight = F.sum(F.size("tokens").cast("bigint")).alias("n")
    return tokens.groupBy(F.get("tokens", F.lit(0)).alias("word")).agg(weight)


@query("select user_id, round(sum(cast(value as decimal(18, 2)))::double / count(value), 6) as average from events group by user_id")
def avg_by_key(t):
    average = exact_sum("value") / F.count("value")
    return t.events.groupBy("user_id").agg(F.round(average, 6).alias("average"))


@query(
    """
    select user_id, event_id, round(sum(cast(value as decimal(18, 2))) over w::double / nullif(count(value) over w, 0), 6) as average
    from events
    window w as (partition by user_id order by event_id rows between unbounded preceding and current row)
    """
)
def avg_running(t):
    done = KeyedSequence(_by_user(t), ["user_id"], ["event_id"]).running(
        total=running_sum(exact_units("value")), n=running_count(F.col("value").isNotNull())
    )
    average = F.round(exact_value(F.col("total")) / F.nullif(F.col("n"), F.lit(0)), 6).alias("average")
    return done.rows().select("user_id", "event_id", average)


@query(
    """
    select user_id, event_id, sum(cast(value as decimal(18, 2))) over w::double as total
    from events
    window w as (partition by user_id order by event_id rows between unbounded preceding and current row)
    """
)
def sum_running(t):
    done = KeyedSequence(_by_user(t), ["user_id"], ["event_id"]).running(total=running_sum(exact_units("value")))
    return done.rows().select("user_id", "event_id", exact_value(F.col("total")).alias("total"))


@query("select event_id, row_number() over (order by event_id) as n from events")
def running_ordinal(t):
    return op.ordinal(t.events.select("event_id"), ["event_id"])


@query("select user_id, count(*) as cnt from events group by user_id")
def table_group_count(t):
    return t.spark.sql("select user_id, count(*) as cnt from {sensor} group by user_id", sensor=t.events)





@query(f"select o_orderkey as orderkey, o_totalprice, l_linenumber, l_quantity from orders join lineitem on o_orderkey = l_orderkey")
def reconcile_inner(t):
    orders = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_totalprice")
    lines = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity")
    return op.reconcile(orders, lines, "orderkey")


@query(
    """
    select 'order' as side, o_orderkey as orderkey, epoch_us(o_orderdate) // 1000 as at_ms from orders
    where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_shipdate between o_orderdate - interval 10 day and o_orderdate + interval 10 day)
    union all
    select 'line', l_orderkey, epoch_us(l_shipdate) // 1000 from lineitem
    where not exists (select 1 from orders where l_orderkey = o_orderkey and l_shipdate between o_orderdate - interval 10 day and o_orderdate + interval 10 day)
    """
)
def unmatched_within(t):
    orders = t.orders.select(F.col("o_orderkey").alias("orderkey"), F.col("o_orderdate").alias("at"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), F.col("l_shipdate").alias("at"))
    day = 24 * 3_600_000
    left, right = op.unmatched_within(orders, lines, "orderkey", "at", "at", -10 * day, 10 * day)
    shown = lambda side, rows: rows.select(F.lit(side).alias("side"), "orderkey", F.unix_millis("at").alias("at_ms"))
    return shown("order", left).unionByName(shown("line", right))


@query(
    """
    select 'order' as side, o_orderkey as orderkey from orders where o_orderkey not in (select l_orderkey from lineitem)
    union all
    select 'line', l_orderkey from lineitem where l_orderkey not in (select o_orderkey from orders)
    """
)
def reconcile_unmatched(t):
    orders = t.orders.select(F.col("o_orderkey").alias("orderkey"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("orderkey"))
    left, right = op.unmatched(orders, lines, "orderkey")
    return left.select(F.lit("order").alias("side"), "orderkey").unionByName(
        right.select(F.lit("line").alias("side"), "orderkey")
    )


@query(
    """
    select o_orderkey as orderkey, l_linenumber, epoch_us(o_orderdate) // 1000 as order_ms, epoch_us(l_shipdate) // 1000 as ship_ms
    from orders join lineitem on o_orderkey = l_orderkey
    where l_shipdate between o_orderdate - interval 10 day and o_orderdate + interval 10 day
    """
)
def interval_join(t):
    day = 86_400_000
    orders = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_orderdate")
    lines = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_shipdate")
    pairs = op.interval_join(orders, lines, "orderkey", "o_orderdate", "l_shipdate", -10 * day, 10 * day)
    return pairs.select(
        "orderkey",
        "l_linenumber",
        F.unix_millis("o_orderdate").alias("order_ms"),
        F.unix_millis("l_shipdate").alias("ship_ms"),
    )


@query(
    """
    select c.user_id, c.event_id as click_id, p.event_id as purchase_id
    from events c join events p on c.user_id = p.user_id
    where c.event_type = 'click' and p.event_type = 'purchase'
      and p.ts between c.ts - interval 1 hour and c.ts + interval 1 hour
    """
)
def interval_join_events(t):
    def side(kind, name):
        rows = t.events.where(F.col("event_type") == kind)
        return rows.select("user_id", F.col("event_id").alias(f"{name}_id"), F.col("ts").alias(f"{name}_ts"))

    hour = 3_600_000
    pairs = op.interval_join(
        side("click", "click"), side("purchase", "purchase"), "user_id", "click_ts", "purchase_ts", -hour, hour
    )
    return pairs.select("user_id", "click_id", "purchase_id")
