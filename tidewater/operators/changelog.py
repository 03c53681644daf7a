"""Changing results as a log of additions and withdrawals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.ordered import KeyedSequence, running_count


def retract_count(df: DataFrame, keys: list[str], order: list[str], out: str = "cnt") -> DataFrame:
    """The running count per key as ``(is_add, keys, order, out)``: the old value is withdrawn, the new one added."""
    counted = KeyedSequence(df.select(*keys, *order), keys, order).running(_n=running_count()).rows()
    changes = F.array(
        F.struct(F.lit(False).alias("is_add"), (F.col("_n") - 1).alias(out)),
        F.struct(F.lit(True).alias("is_add"), F.col("_n").alias(out)),
    )
    return (
        counted.select(*keys, *order, F.explode(changes).alias("_c"))
        .select("_c.is_add", *keys, *order, f"_c.{out}")
        .where(F.col(out) > 0)
    )


def aggregate_changelog(log: DataFrame, keys: list[str], value: str, is_add: str = "is_add") -> DataFrame:
    """``keys, n, total, low, high``: count, sum, minimum and maximum of the values that additions and withdrawals leave.

    The log is a counted multiset: a withdrawal takes away one equal value, also if it comes before its addition. Additions and withdrawals of
    one value are netted before the shuffle, so minimum and maximum need no history; a value with nothing left, or with more withdrawals than
    additions, is not there for them. NULL values count in ``n`` only. Groups with nothing left are not in the result.
    """
    one = F.when(F.col(is_add), F.lit(1)).otherwise(F.lit(-1)).cast("bigint")
    held = log.groupBy(*keys, F.col(value).alias("_value")).agg(F.sum(one).alias("_net")).where(F.col("_net") != 0)
    there = F.when(F.col("_net") > 0, F.col("_value"))
    done = held.groupBy(*keys).agg(
        F.sum("_net").alias("n"), F.sum(F.col("_value") * F.col("_net")).alias("total"), F.min(there).alias("low"), F.max(there).alias("high")
    )
    return done.where(F.col("n") > 0)
