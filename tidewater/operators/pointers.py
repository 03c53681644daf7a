"""The no-drop rule for keys of any size: next-event pointers, found in parallel, and pointer doubling along them.

A timer that starts at a row has one next event, whatever happened before: the first lower value within the wait, or the first row
after it. Either leads to the next row that starts a timer. So rows form a graph with one pointer each, and the timers
that really ran are those on the path from a key's first row.

* The row after the wait comes from a running minimum in descending order of time, over rows and expiries together.
* The next lower value comes from a tree of minima over row numbers, 64 children a node: rows climb until a later child within the wait
  is lower, then descend to its first lower row. Rows climb no further than their wait reaches.
* The path is shortened block by block (arrays of 1024 pointers), doubled over the rows at which paths enter blocks, and
  then walked inside the blocks that it enters.

Every step is a join or an aggregation over all tasks; no group is larger than a node, a block or the digits of a running minimum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.ordered import KeyedSequence, running_count, running_min
from tidewater.session import checkpointed

#: Bits of the children of a node of the tree, and of the rows of a block.
NODE_BITS, BLOCK_BITS = 6, 10


def timer_path(rows: DataFrame, wait: int) -> DataFrame:
    """``key, alarm_us``: the timers that expired, for rows ``key, ts, _us, _seq, _v`` of large keys; ``key`` is an integer."""
    numbered = KeyedSequence(rows, ["key"], ["ts", "_seq"]).running(rn=running_count()).rows()
    numbered = checkpointed(numbered.select("key", "rn", F.col("_us").alias("us"), F.col("_v").alias("v")))
    graph = checkpointed(_next_timers(numbered, wait).withColumnRenamed("alarm_us", "mark"))
    return marks_on_path(graph).withColumnRenamed("mark", "alarm_us")


def _next_timers(numbered: DataFrame, wait: int) -> DataFrame:
    """``key, rn, next, alarm_us``: the row that starts the next timer, NULL at the end, and when this one expires, NULL if it is stopped."""
    lagged = KeyedSequence(numbered, ["key"], ["rn"]).with_window(1, lambda w: {"before": F.lag("v", 1).over(w)})
    starts = F.when(F.col("before").isNull() | (F.col("v") >= F.col("before")), F.col("rn"))
    turned = lagged.rows().withColumns({"neg": -F.col("rn"), "starts": starts})
    # After a drop at a row, the next timer starts at the first later row that is not lower than its predecessor.
    resumed = KeyedSequence(turned, ["key"], ["neg"]).running(resume=running_min("starts", inclusive=False)).rows()
    resumed = checkpointed(resumed.select("key", "rn", "us", "v", "resume"))

    probe = resumed.select("key", "rn", F.lit(None).cast("struct<rn:bigint,v:double,resume:bigint>").alias("row"), (-F.col("us") - F.lit(wait)).alias("neg"), F.lit(1).alias("kind"))
    own = resumed.select("key", "rn", F.struct("rn", "v", "resume").alias("row"), (-F.col("us")).alias("neg"), F.lit(0).alias("kind"))
    late_first = KeyedSequence(own.unionByName(probe), ["key"], ["neg", "kind", "rn"]).running(after=running_min("row")).rows()
    after = late_first.where("kind = 1").select("key", "rn", "after")
    waiting = checkpointed(resumed.join(after, ["key", "rn"]))

    lower = _next_lower(waiting)
    found = waiting.join(lower, ["key", "rn"], "left")
    dropped = F.col("lower").isNotNull()
    expired = F.when(F.col("after.v") < F.col("v"), F.col("after.resume")).otherwise(F.col("after.rn"))
    return found.select(
        "key",
        "rn",
        F.when(dropped, F.col("lower.resume")).otherwise(expired).alias("next"),
        F.when(~dropped, F.col("us") + F.lit(wait)).alias("alarm_us"),
    )


def _next_lower(rows: DataFrame) -> DataFrame:
    """``key, rn, lower``: the next lower row (``rn, v, resume``) among those before ``after``; rows without one are left out."""
    fan = NODE_BITS
    top = rows.agg(F.max("rn")).first()[0] or 0
    node = lambda level: F.shiftright("rn", fan * level)
    leaf = rows.groupBy("key", node(1).alias("node")).agg(
        F.array_sort(F.collect_list(F.struct("rn", "v", "resume"))).alias("children"), F.min("v").alias("low")
    )
    levels = [checkpointed(leaf)]
    while top >> (fan * len(levels)):
        below = levels[-1].select("key", F.shiftright("node", fan).alias("up"), F.struct(F.col("node").alias("rn"), F.col("low").alias("v")).alias("child"), "low")
        levels.append(checkpointed(below.groupBy("key", F.col("up").alias("node")).agg(F.array_sort(F.collect_list("child")).alias("children"), F.min("low").alias("low"))))

    last = F.coalesce(F.col("after.rn") - F.lit(1), F.lit(top))
    asking = rows.select("key", "rn", "v", last.alias("last")).where("rn < last")
    at_level: list[DataFrame] = []
    for level, nodes in enumerate(levels, 1):
        # Children of a node are numbered by their leading bits; those up to the last row of the wait count.
        place, reach = node(level - 1), F.shiftright("last", fan * (level - 1))
        joined = asking.withColumn("node", node(level)).join(nodes.select("key", "node", "children"), ["key", "node"])
        first = _first(lambda c: (c["rn"] > place) & (c["rn"] <= reach) & (c["v"] < F.col("v")))
        climbed = checkpointed(joined.withColumn("child", first).drop("children", "node"))
        at_level.append(climbed.where("child is not null"))
        asking = climbed.where(F.col("child").isNull() & (F.shiftright("last", fan * level) > node(level))).drop("child")
    found = None
    for level in range(len(levels), 1, -1):
        here = at_level[level - 1].select("key", "rn", "v", "last", F.col("child.rn").alias("node"))
        down = here if found is None else here.unionByName(found)
        nodes = levels[level - 2].select("key", "node", "children")
        child = down.join(nodes, ["key", "node"]).withColumn("child", _first(lambda c: c["v"] < F.col("v"))).drop("children", "node")
        if level > 2:
            found = child.select("key", "rn", "v", "last", F.col("child.rn").alias("node"))
        else:
            found = child
    lowest = at_level[0] if found is None else at_level[0].unionByName(found)
    return lowest.where(F.col("child.rn") <= F.col("last")).select("key", "rn", F.col("child").alias("lower"))


def _first(condition) -> Column:
    return F.get(F.filter("children", condition), F.lit(0))


def marks_on_path(graph: DataFrame) -> DataFrame:
    """``key, mark``: the marks that are not NULL on the path from row 1 of every key, for ``key, rn, next, mark``.

    Rows of a key are numbered from 1 without gaps; ``next`` is a later row or NULL, ``mark`` a bigint.
    """
    size = 1 << BLOCK_BITS
    ordered = F.array_sort(F.collect_list(F.struct("rn", "next", "mark")))
    blocks = graph.groupBy("key", F.shiftright("rn", BLOCK_BITS).alias("block")).agg(ordered.alias("rows"))
    blocks = checkpointed(blocks.withColumns({"base": F.col("rows")[0]["rn"], "end": F.element_at("rows", -1)["rn"]}))

    def onward(place: Column, pointers: Column) -> Column:
        return F.when(place <= F.col("end"), F.get(pointers, (place - F.col("base")).cast("int"))).otherwise(place)

    doubled = F.aggregate(F.sequence(F.lit(1), F.lit(BLOCK_BITS)), F.col("rows.next"), lambda held, _: F.transform(held, lambda x: onward(x, held)))
    leaving = blocks.select("key", F.posexplode(F.arrays_zip(F.col("rows.rn").alias("rn"), doubled.alias("leaves")))).select("key", "col.rn", "col.leaves")
    leaving = checkpointed(leaving)

    # Only rows at which a path enters a block matter from here on.
    entered = leaving.select("key", F.col("leaves").alias("rn")).where("rn is not null").distinct()
    jumps = checkpointed(leaving.join(entered, ["key", "rn"], "left_semi").unionByName(leaving.where("rn = 1")).distinct().where("leaves is not null"))
    reached = leaving.select("key").distinct().withColumn("rn", F.lit(1).cast("bigint"))
    while True:
        further = reached.join(jumps, ["key", "rn"]).select("key", F.col("leaves").alias("rn"))
        reached = checkpointed(reached.unionByName(further).distinct())
        later = jumps.select("key", F.col("rn").alias("leaves"), F.col("leaves").alias("onward"))
        jumps = checkpointed(jumps.join(later, ["key", "leaves"]).select("key", "rn", F.col("onward").alias("leaves")))
        if not jumps.take(1):
            break

    # A path goes through a block once, from where it enters it.
    nothing = F.array().cast("array<bigint>")
    start = F.struct(F.col("rn").alias("at"), nothing.alias("marks"))

    def step(walk: Column, _: Column) -> Column:
        row = F.get("rows", (walk["at"] - F.col("base")).cast("int"))
        marks = F.when(row["mark"].isNotNull(), F.concat(walk["marks"], F.array(row["mark"]))).otherwise(walk["marks"])
        return F.when(walk["at"] <= F.col("end"), F.struct(row["next"].alias("at"), marks.alias("marks"))).otherwise(walk)

    inside = reached.withColumn("block", F.shiftright("rn", BLOCK_BITS)).join(blocks, ["key", "block"])
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(size)), start, step)
    return inside.select("key", F.explode(walked["marks"]).alias("mark"))
