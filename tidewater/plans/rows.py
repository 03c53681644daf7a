"""Sources, projections, filters, partitioning, unions and tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater import operators as op
from tidewater import sinks, sources
from tidewater.functions import json_value, split_words, utf16_length
from tidewater.functions.tables import register_table_functions
from tidewater.plans.registry import query


@query("select doc_id, text as value from documents")
def scan_text(t):
    return t.documents.select("doc_id", F.col("text").alias("value"))


@query("select user_id, event_type, event_id, value from events")
def parse_delimited(t):
    line = F.concat_ws(",", "user_id", "event_type", "event_id", "value").alias("value")
    schema = T.StructType(
        [
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("event_id", T.LongType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
    return sources.parse_delimited(t.events.select(line), schema)


@query("select * from nation")
def sql_scan(t):
    return sources.sql_over(t.spark, "select * from {emp}", emp=t.nation)


@query(
    """
    select event_id,
           '{"user_id":' || user_id || ',"event_type":"' || event_type || '","event_id":' || event_id || '}' as value
    from events
    """
)
def to_json_value(t):
    return t.events.select("event_id", json_value("user_id", "event_type", "event_id").alias("value"))


@query(
    """
    select user_id, event_id, event_type, value
    from (select *, row_number() over (partition by user_id order by event_id desc) as rn from events)
    where rn = 1
    """
)
def dedup_latest(t):
    return sinks.dedup_latest(t.events.select("user_id", "event_id", "event_type", "value"), ["user_id"], ["event_id"])


@query(
    """
    select doc_id,
           length(regexp_replace(text, '[\\x{10000}-\\x{10FFFF}]', 'xx', 'g'))::bigint as n
    from documents
    """
)
def map_length(t):
    return t.documents.select("doc_id", utf16_length("text").alias("n"))


@query("select event_id, user_id, value * 2 as doubled from events")
def map_rich(t):
    return op.rich_map(
        t.events.select("event_id", "user_id", "value"),
        "event_id bigint, user_id bigint, doubled double",
        lambda factor, rows: rows.assign(doubled=rows["value"] * factor)[["event_id", "user_id", "doubled"]],
        opens=lambda: 2,
    )


_WORDS = """
    words as (
        select doc_id, unnest(tokens) as word, unnest(range(len(tokens))) as pos
        from (
            select doc_id,
                   case when text = '' then ['']
                        when rtrim(text, ' ') = '' then []
                        else string_split(rtrim(text, ' '), ' ') end as tokens
            from documents
        )
    )
"""


@query(f"with {_WORDS} select doc_id, pos::bigint as pos, word from words")
def flat_map_words(t):
    tokens = op.words(t.documents.select("doc_id", F.col("text").alias("value")), position="pos")
    return tokens.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "word")


@query("select user_id, event_id, 1::bigint as one from events where event_type = 'view'")
def flat_map_filter(t):
    views = t.events.where(F.col("event_type") == "view")
    return views.select("user_id", "event_id", F.lit(1).cast("bigint").alias("one"))


@query("select event_id, user_id, value from events where value > 42.5")
def filter_gt(t):
    return t.events.where(F.col("value") > 42.5).select("event_id", "user_id", "value")


@query("select event_id, props from events where props is not null")
def filter_not_null(t):
    return t.events.where(F.col("props").isNotNull()).select("event_id", "props")


@query("select user_id, event_id from events where user_id = 7")
def table_where_select(t):
    return t.events.where(F.col("user_id") == 7).select("user_id", "event_id")


@query("select user_id, event_id from events where user_id = 7")
def table_where_select_text(t):
    return t.events.where("user_id = 7").select("user_id", "event_id")


@query(
    """
    select event_id, length(event_type)::bigint as type_length, string_split(event_type, 'i')[1] as head,
           user_id || ':' || event_type as label, abs(value - 50) as distance, greatest(value, 100) as at_least_100,
           user_id = 7 as is_seven, cast(cast(user_id as varchar) as bigint) as parsed,
           epoch_us(make_timestamp(user_id * 1000000)) // 1000 as as_ms
    from events
    """
)
def scalar_functions(t):
    return t.events.select(
        "event_id",
        utf16_length("event_type").alias("type_length"),
        F.get(split_words("event_type", "i"), F.lit(0)).alias("head"),
        F.concat(F.col("user_id").cast("string"), F.lit(":"), F.col("event_type")).alias("label"),
        F.abs(F.col("value") - 50).alias("distance"),
        F.greatest("value", F.lit(100.0)).alias("at_least_100"),
        (F.col("user_id") == 7).alias("is_seven"),
        F.col("user_id").cast("string").cast("bigint").alias("parsed"),
        F.unix_millis(F.timestamp_seconds("user_id")).alias("as_ms"),
    )


@query("select user_id, count(*) as n from events group by user_id")
def key_by_count(t):
    return t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("select event_id, user_id, event_type, value from events")
def shuffle_rows(t):
    return op.shuffle_rows(t.events.select("event_id", "user_id", "event_type", "value"))


@query(
    """
    select event_id, value from events where event_type = 'view'
    union all select event_id, value from events where value > 20
    union all select o_orderkey, o_totalprice from orders
    """
)
def union_all(t):
    rows = t.events.select("event_id", "value", "event_type")
    return op.union_all(
        rows.where(F.col("event_type") == "view").drop("event_type"),
        rows.where(F.col("value") > 20).drop("event_type"),
        t.orders.select(F.col("o_orderkey").alias("event_id"), F.col("o_totalprice").alias("value")),
    )


@query(
    """
    select 'left' as source, length(event_type)::varchar as value from events
    union all select 'right', o_orderstatus from orders
    """
)
def connect_comap(t):
    return op.co_map(
        t.events, t.orders, F.length("event_type").cast("string"), F.col("o_orderstatus")
    )


@query("select event_id, user_id, value from events where value >= 40 or value is null")
def split_main(t):
    return op.split_rows(t.events.select("event_id", "user_id", "value"), F.col("value") < 40)[0]


@query("select event_id, user_id || ':water level:' || value as message from events where value < 40")
def split_side(t):
    side = op.split_rows(t.events.select("event_id", "user_id", "value"), F.col("value") < 40)[1]
    return side.select("event_id", F.concat_ws(":water level:", "user_id", "value").alias("message"))


@query(
    """
    with marked as (
        select user_id, event_id, event_type,
               row_number() over (partition by user_id order by event_id) - row_number() over (partition by user_id, event_type order by event_id) as island
        from events
    )
    select user_id as key, min(event_id) as first_seq, max(event_id) as last_seq, event_type as value, count(*) as n
    from marked group by user_id, event_type, island
    """
)
def table_function_runs(t):
    register_table_functions(t.spark)
    rows = t.events.select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), F.col("event_type").alias("value"))
    return sources.sql_over(t.spark, "select * from runs(table(select * from {rows}) partition by key order by seq)", rows=rows)


@query("select p_partkey, i as place, words[i + 1] as word from (select p_partkey, string_split(p_name, ' ') as words from part), range(50) r(i) where i < len(words)")
def table_function_words(t):
    register_table_functions(t.spark)
    text = "select p_partkey, w.place, w.word from {parts} join lateral words(p_name) w"
    return sources.sql_over(t.spark, text, parts=t.part.select("p_partkey", "p_name"))
