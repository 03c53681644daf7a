"""Two-input matching. Unequal sizes and hot keys are left to adaptive execution (skew split, measured broadcast)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.windows import floor_to


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Pairs of rows with the same key, whichever arrived first. Rows without a partner are not in the result.

    Keys are meant to be unique per side; with repeats every combination is a pair. Works on streams: give both
    sides a watermark and add a time bound, or accept unbounded state.
    """
    return left.join(right, key, "inner")


def unmatched(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of each side whose key the other side does not have (a NULL key never has a partner)."""
    return left.join(right.select(key), key, "left_anti"), right.join(left.select(key), key, "left_anti")


def unmatched_within(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, lower_ms: int, upper_ms: int
) -> tuple[DataFrame, DataFrame]:
    """Rows of each side without a partner: none with the same key and ``left_ts + lower <= right_ts <= left_ts + upper``.

    Rows without a key or time have no partner. Time slots are part of the join key, as for ``interval_join``.
    """

    def alone(ours: DataFrame, theirs: DataFrame, our_ts: str, their_ts: str, lower: int, upper: int) -> DataFrame:
        slot = 2 * max(upper - lower, 1) * 1000
        at = F.unix_micros(F.col("_at"))
        first, last = floor_to(at - upper * 1000, slot), floor_to(at - lower * 1000, slot)
        offered = theirs.select(F.col(key).alias("_key"), F.col(their_ts).alias("_at")).where(F.col("_at").isNotNull()).distinct()
        offered = offered.withColumn("_slot", F.explode(F.sequence(first, last, F.lit(slot).cast("bigint"))))
        own = F.unix_micros(our_ts)
        near = (at - own).between(lower * 1000, upper * 1000)
        return ours.join(offered, (F.col(key) == F.col("_key")) & (floor_to(own, slot) == F.col("_slot")) & near, "left_anti")

    return alone(left, right, left_ts, right_ts, lower_ms, upper_ms), alone(right, left, right_ts, left_ts, -upper_ms, -lower_ms)


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, lower_ms: int, upper_ms: int
) -> DataFrame:
    """Pairs with the same key and ``left_ts + lower <= right_ts <= left_ts + upper``, both ends included.

    Time is part of the join key: a left row belongs to one time slot, a right row is offered to the one or two slots
    that can hold partners. So the two histories of a busy key are not compared in full, and such a key is spread
    over many tasks.
    """
    span = max(upper_ms - lower_ms, 1) * 1000
    slot = 2 * span
    l_us, r_us = F.unix_micros(left_ts), F.unix_micros(right_ts)
    first, last = floor_to(r_us - upper_ms * 1000, slot), floor_to(r_us - lower_ms * 1000, slot)
    placed = left.where(F.col(left_ts).isNotNull()).withColumn("_slot", floor_to(l_us, slot))
    offered = right.where(F.col(right_ts).isNotNull()).withColumn(
        "_slot", F.explode(F.sequence(first, last, F.lit(slot).cast("bigint")))
    )
    distance = F.unix_micros(right_ts) - F.unix_micros(left_ts)
    return (
        placed.join(offered, [key, "_slot"], "inner")
        .where(distance.between(lower_ms * 1000, upper_ms * 1000))
        .drop("_slot")
    )
