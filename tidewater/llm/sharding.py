"""Shards of nearly equal size that keep equal texts together: a minimax partition of ordered groups.

Groups stand in the order of a hash. A capacity is feasible if cutting greedily, each shard as long as it fits, needs no more
shards than there are; the smallest feasible capacity is found by binary search, and the groups are cut there. Groups of a fair
share or more come first and fill a shard each, so that they don't leave the other shards unequal.

Search and greedy check are one expression over a row with the *boundaries* of blocks of groups, at most about 2**17 of them. A block of
one group is solid: greedy never cuts it. Cutting only at boundaries gives an upper bound of the capacity, cutting
anywhere in a block that is not solid a lower bound. Blocks that the cuts between the two bounds can reach are made finer until both bounds
are one: the exact optimum for any number of groups.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import discard, durable

#: Cells that the places of all groups are divided into at first; a cell has a block and a solid block at most.
CELLS = 1 << 16
#: Parts of a shard whose rows are numbered side by side.
PARTS = 4096
#: Groups are summed up in buckets of this many leading bits of their hash.
_BUCKET_BITS = 16


def shard_texts(docs: DataFrame, ids: list[str], text: str = "text", shards: int = 16) -> DataFrame:
    """``ids, size, text_crc32, shard, slot`` for every row: equal texts share a shard, the largest shard is as small as the order allows.

    ``size`` is the UTF-8 bytes of the text plus 1, ``slot`` counts the rows of a shard from 0 without gaps. Null texts are one group
    of rows of size 1 with ``text_crc32`` 0; empty texts are another one. Very long texts and texts that fill several fair
    shares stay whole in one shard. Repeated rows each get a slot. An empty table gives no rows. Other columns of ``docs``, whatever their
    names, are not read. Texts whose 64-bit hashes are equal share a group.
    """
    if clash := {"size", "text_crc32", "shard", "slot"} & set(ids):
        raise ValueError(f"columns {sorted(clash)} are results")
    places = {f"id_{i}": name for i, name in enumerate(ids)}
    body = F.col(text)
    rows = durable(
        docs.select(
            *[F.col(name).alias(place) for place, name in places.items()],
            (F.coalesce(F.octet_length(body), F.lit(0)) + F.lit(1)).cast("bigint").alias("size"),
            F.coalesce(F.crc32(body), F.lit(0)).cast("bigint").alias("text_crc32"),
            F.xxhash64(body).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sharding-rows",
    )
    groups = durable(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "sharding-groups")
    alone, cuts = minimax_cuts(groups, shards)
    discard(groups)
    placed = rows.withColumn("shard", _shard_of(F.col("key"), alone, cuts)).withColumn("part", F.pmod(F.xxhash64("row"), F.lit(PARTS)))
    numbered = _number(placed, ["shard"], "part", "row", "slot")
    return numbered.select(*[F.col(place).alias(name) for place, name in places.items()], "size", "text_crc32", "shard", "slot")


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[list[int], list[int]]:
    """(keys of groups that fill a shard each, keys at which a new shard starts) for ``groups`` of unique ``key`` and ``bytes`` above 0.

    The driver reads the ``shards`` largest groups and the bounds of each step.
    """
    left = groups.agg(F.sum("bytes")).first()[0] or 0
    alone: list[int] = []
    for key, size in groups.orderBy(F.desc("bytes"), "key").limit(shards).collect():
        if not left or size * (shards - len(alone)) < left:
            break
        alone.append(key)
        left -= size
    open_shards = shards - len(alone)
    if not left or open_shards <= 1:
        return alone, []
    placed = durable(_with_starts(groups.where(~F.col("key").isin(alone)) if alone else groups), "sharding-starts")
    width, windows = _power_of_two(-(-left // CELLS)), []
    low, high = -(-left // open_shards), left
    while True:
        low, high, below, above, keys = _bounds(placed, width, windows, left, open_shards, low, high)
        if low == high:
            break
        windows = list(zip(below, above))
        reach = sum(b - a + 1 for a, b in windows)
        width = max(1, min(width // 2, _power_of_two(-(-reach // CELLS))))
    discard(placed)
    return alone, [key for key in keys if key is not None]


def _power_of_two(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def _with_starts(groups: DataFrame) -> DataFrame:
    """Groups with ``start``, the bytes of all groups before them in the order of ``key``."""
    groups = groups.withColumn("bucket", F.shiftright("key", 64 - _BUCKET_BITS))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = groups.groupBy("bucket").agg(F.sum("bytes").alias("total"))  # 2**16 rows at most
    offsets = sums.select("bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    return groups.withColumn("start", F.coalesce(F.sum("bytes").over(inside), F.lit(0))).join(F.broadcast(offsets), "bucket").select(
        "key", "bytes", (F.col("start") + F.col("offset")).alias("start")
    )


def _bounds(placed: DataFrame, width: int, windows: list[tuple[int, int]], total: int, shards: int, low: int, high: int):
    """(lower bound, upper bound, least cuts, greatest cuts, keys at the cuts of the upper bound) from blocks in cells of ``width``."""
    if windows:
        reached = F.lit(False)
        for a, b in windows:
            reached = reached | F.col("start").between(a, b)
        placed = placed.where(reached)
    # A group of a cell's width or more is the last one that starts in its cell, so blocks don't interleave.
    cell, large = F.expr(f"start div {width}"), F.col("bytes") >= width
    blocks = placed.groupBy(cell.alias("cell"), large.alias("large")).agg(
        F.min("start").alias("at"), F.min_by("key", "start").alias("key"), (F.count(F.lit(1)) == 1).alias("solid")
    )
    row = blocks.agg(F.array_sort(F.collect_list(F.struct("at", "key", "solid"))).alias("block")).select(
        F.concat("block.at", F.array(F.lit(total).cast("bigint"))).alias("at"),
        F.concat("block.solid", F.array(F.lit(True))).alias("solid"),
        F.col("block.key").alias("key"),
    )
    row = durable(row, "sharding-blocks")
    lenient, strict = (lambda c: _ends(c, shards, total, True)), (lambda c: _ends(c, shards, total, False))
    low, high = row.select(_smallest(low, high, lenient), _smallest(low, high, strict)).first()
    inner = lambda ends: F.slice(ends, 1, shards - 1)
    last = row.select("*", inner(strict(F.lit(high))).alias("cuts"), inner(strict(F.lit(low))).alias("least"), inner(lenient(F.lit(high))).alias("most"))
    least, most, keys = last.select("least", "most", F.transform("cuts", lambda x: F.get("key", _last_upto(x)))).first()
    discard(row)
    return low, high, least, most, keys


def _smallest(low: int, high: int, ends: Callable[[Column], Column]) -> Column:
    """The smallest capacity from ``low`` to ``high`` whose greedy ends reach the end; ``high`` is known to."""

    def halve(span: Column, _: Column) -> Column:
        middle = span["low"] + F.shiftright(span["high"] - span["low"], 1)
        judged = F.transform(F.array(middle), lambda c: F.when(F.element_at(ends(c), -1) == F.element_at("at", -1), _span(span["low"], c)).otherwise(_span(c + F.lit(1), span["high"])))
        return F.when(span["low"] >= span["high"], span).otherwise(judged[0])

    steps = F.sequence(F.lit(1), F.lit((high - low).bit_length() + 1))
    return F.aggregate(steps, _span(F.lit(low), F.lit(high)), halve)["high"]


def _span(low: Column, high: Column) -> Column:
    return F.struct(low.cast("bigint").alias("low"), high.cast("bigint").alias("high"))


def _ends(capacity: Column, shards: int, total: int, optimistic: bool) -> Column:
    """Where each shard ends when it takes groups as long as they fit: at a boundary, or anywhere in a block that is not solid."""

    def fill(ends: Column, _: Column) -> Column:
        goal = F.least(F.element_at(ends, -1) + capacity, F.lit(total).cast("bigint"))

        def stop(x: Column) -> Column:
            at = F.transform(F.array(_last_upto(x)), lambda i: F.get("at", i) if not optimistic else F.when(F.get("solid", i), F.get("at", i)).otherwise(x))
            return F.array(at[0])

        return F.concat(ends, F.transform(F.array(goal), stop)[0])

    ends = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), F.array(F.lit(0).cast("bigint")), fill)
    return F.slice(ends, 2, shards)


def _last_upto(x: Column) -> Column:
    """Index of the last boundary that is not above ``x``, by binary search in the column ``at``."""

    def halve(span: Column, _: Column) -> Column:
        middle = F.shiftright(span["low"] + span["high"], 1)
        upper = F.struct(middle.alias("low"), span["high"].alias("high"))
        lower = F.struct(span["low"].alias("low"), middle.alias("high"))
        return F.when(span["high"] - span["low"] <= 1, span).when(F.get("at", middle) <= x, upper).otherwise(lower)

    start = F.struct(F.lit(0).alias("low"), F.size("at").alias("high"))
    steps = F.sequence(F.lit(1), F.length(F.bin(F.size("at"))))
    return F.aggregate(steps, start, halve)["low"]


def _shard_of(key: Column, alone: list[int], cuts: list[int]) -> Column:
    shard = F.lit(len(alone))
    for cut in cuts:
        shard = shard + (key >= F.lit(cut)).cast("int")
    for place, own in enumerate(alone):
        shard = F.when(key == F.lit(own), F.lit(place)).otherwise(shard)
    return shard


def _number(rows: DataFrame, keys: list[str], part: str, order: str, out: str) -> DataFrame:
    """Number the rows of every key from 0: first over the parts of a key, then within a part."""
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*keys, part).agg(F.count(F.lit(1)).alias("_n"))  # a row for every shard and part at most
    offsets = counts.select(*keys, part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*keys, part).orderBy(order)) - F.lit(1)
    return rows.withColumn(out, place).join(F.broadcast(offsets), [*keys, part]).withColumn(out, (F.col(out) + F.col("_before")).cast("bigint"))
