"""Patterns of consecutive rows per key, in the order given (usually time, then arrival)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.ordered import KeyedSequence, running_count, running_min
from tidewater.operators.pointers import marks_on_path
from tidewater.session import checkpointed


def match_sequence(
    df: DataFrame, keys: list[str], order: list[str], ts: str, steps: list[Column], within_ms: int | None = None
) -> DataFrame:
    """Matches of ``steps`` on directly consecutive rows: ``keys, first_ts, last_ts`` per match.

    Matches may overlap. ``within_ms`` asks for last minus first strictly below it.
    """
    back = len(steps) - 1
    flagged = df.select(
        *keys, *[c for c in dict.fromkeys([*order, ts]) if c not in keys], *[s.alias(f"_s{i}") for i, s in enumerate(steps)]
    )

    def look(window):
        held = [F.lag(f"_s{i}", back - i).over(window) for i in range(back)]
        return {"_before": reduce(lambda a, b: a & b, held, F.lit(True)), "first_ts": F.lag(ts, back).over(window)}

    found = KeyedSequence(flagged, keys, order).with_window(max(back, 1), look)
    found = found.where(F.col(f"_s{back}") & F.col("_before"))
    return _within(found.rows(), keys, ts, within_ms)


def match_times(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    ts: str,
    condition: Column,
    times: int,
    within_ms: int | None = None,
    consecutive: bool = True,
) -> DataFrame:
    """``condition`` ``times`` times in a row. Without ``consecutive`` other rows of the key may lie in between."""
    if consecutive:
        return match_sequence(df, keys, order, ts, [condition] * times, within_ms)
    return match_sequence(df.where(condition), keys, order, ts, [F.lit(True)] * times, within_ms)


def match_relaxed_sequence(
    df: DataFrame, keys: list[str], order: list[str], ts: str, steps: list[Column], within_ms: int | None = None, skip: str = "none"
) -> DataFrame:
    """Matches of ``steps`` in this order, other rows of the key in between: ``keys, first_ts, last_ts`` per match.

    Every row that fits the first step starts at most one match, which goes on with the next row that fits each further step.
    ``skip="none"`` gives all of them, ``"past_last"`` only those that start after the last row of the match before. ``within_ms`` asks for
    last minus first strictly below it.

    From the last step backwards, a running minimum in descending order hands every row the next row that fits a step,
    together with where the match ends from there: one ordered pass a step, without partial matches.
    """
    if skip not in ("none", "past_last"):
        raise ValueError(f"unknown skip rule {skip}")
    flagged = df.select(
        *keys, *[c for c in dict.fromkeys([*order, ts]) if c not in keys], *[s.alias(f"_s{i}") for i, s in enumerate(steps)]
    )
    numbered = KeyedSequence(flagged, keys, order).running(_rn=running_count()).rows()
    found = KeyedSequence(numbered.withColumn("_back", -F.col("_rn")), keys, ["_back"])
    here = F.struct("_rn", F.col("_rn").alias("last_rn"), F.col(ts).alias("last_ts"))
    for step in range(len(steps) - 1, 0, -1):
        found = found.running(_next=running_min(F.when(F.col(f"_s{step}"), here), inclusive=False))
        found = found._with(found.df.withColumn(f"_n{step}", F.col("_next")).drop("_next"))
        known = F.col(f"_n{step}")
        here = F.when(known.isNotNull(), F.struct("_rn", known["last_rn"].alias("last_rn"), known["last_ts"].alias("last_ts")))
    rows = found.df.withColumn("_end", F.when(F.col("_s0"), here))
    if within_ms is not None:
        rows = rows.withColumn("_end", F.when(F.unix_micros("_end.last_ts") - F.unix_micros(ts) < within_ms * 1000, F.col("_end")))
    starts = F.col("_end").isNotNull()
    if skip == "past_last":
        rows, starts = _taken(found._with(rows), keys), F.col("_took")
    return rows.where(starts).select(*keys, F.col(ts).alias("first_ts"), F.col("_end.last_ts").alias("last_ts"))


def _taken(sequence: KeyedSequence, keys: list[str]) -> DataFrame:
    """Rows with ``_took``: whether the match that starts here is reached when each next one starts behind the last row of the one before."""
    later = running_min(F.when(F.col("_end").isNotNull(), F.col("_rn")), inclusive=False)
    rows = checkpointed(sequence.running(_later=later).rows())
    named = {k: f"_own_{i}" for i, k in enumerate(keys)}
    ids = checkpointed(rows.select(*keys).distinct().withColumn("key", F.monotonically_increasing_id())).withColumnsRenamed(named)
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in named.items()] or F.lit(True)
    known = checkpointed(rows.join(ids, same).drop(*named.values()))
    behind = known.select("key", F.col("_rn").alias("_last"), F.col("_later").alias("_after"))
    starts = known.where(F.col("_end").isNotNull()).select("key", "_rn", F.col("_end.last_rn").alias("_last")).join(behind, ["key", "_last"])
    other = known.where(F.col("_end").isNull()).select("key", F.col("_rn").alias("rn"), F.col("_later").alias("next"), F.lit(None).cast("bigint").alias("mark"))
    graph = other.unionByName(starts.select("key", F.col("_rn").alias("rn"), F.col("_after").alias("next"), F.col("_rn").alias("mark")))
    path = marks_on_path(checkpointed(graph)).select("key", F.col("mark").alias("_rn"), F.lit(True).alias("_took"))
    return known.join(path, ["key", "_rn"], "left").withColumn("_took", F.coalesce("_took", F.lit(False)))


def _within(found: DataFrame, keys: list[str], ts: str, within_ms: int | None) -> DataFrame:
    done = found.select(*keys, "first_ts", F.col(ts).alias("last_ts"))
    if within_ms is None:
        return done
    return done.where(F.unix_micros("last_ts") - F.unix_micros("first_ts") < within_ms * 1000)
