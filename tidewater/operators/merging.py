"""Event-time sessions that merge, with allowed lateness: what a stream that moves its watermark after every row would emit.

A row opens ``[ts, ts + gap)`` and first joins every open session of its key that this touches; it may bridge two sessions that have
fired. It is dropped only if it touches none and its own window is closed. A session fires when the watermark reaches its end - 1, fires again with
each row it accepts after that, and is forgotten (closed) when the watermark reaches its end - 1 + lateness. A session that grows beyond
the watermark by a row fires again once the watermark has passed it.

Only rows of one *stretch* (rows of a key that are at most ``gap`` apart, late or not) can meet in a session. A stretch whose rows all
arrived ahead of any session that could have fired is one session and is aggregated by columns alone; the others are walked, a
stretch at a time, in arrival order. The walk keeps the open sessions of one stretch, never rows; a stretch is walked by one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.late import replay_watermark
from tidewater.operators.windows import MERGE, mark_sessions
from tidewater.session import checkpointed

FIRE, ASIDE_ROW, OPEN = "fire", "aside", "open"
_FOLD = {"sum": lambda a, b: a + b, "max": max, "min": min}
NEVER = 2**62


def merging_sessions(
    df: DataFrame, keys: list[str], ts_ms: str, order: list[str], gap_ms: int, delay_ms: int, lateness_ms: int = 0, **folds: tuple[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """(firings ``keys, session_start_ms, session_end_ms, folds``; dropped rows ``keys, order, ts_ms``).

    ``folds`` are ``name=(kind, value)`` with kind sum, max or min. Without lateness every session fires once. At the end of the rows
    all sessions that are still to fire do. Rows without a time take no part.
    """
    data = df.where(F.col(ts_ms).isNotNull()).select(
        *keys, *[c for c in order if c not in keys], *([ts_ms] if ts_ms not in [*keys, *order] else []), *[value.alias(f"_fold_{name}") for name, (_, value) in folds.items()]
    )
    marked = mark_sessions(data.withColumn("_us", F.col(ts_ms) * F.lit(1000)), keys, gap_ms).drop("_us").withColumnRenamed("_start", "_stretch")
    seen = checkpointed(replay_watermark(marked, ts_ms, order, delay_ms))
    return walk_stretches(seen, keys, ts_ms, order, gap_ms, lateness_ms, folds)


def sessions_bounded(
    df: DataFrame, keys: list[str], ts_ms: str, order: list[str], gap_ms: int, delay_ms: int, **folds: tuple[str, Column]
) -> DataFrame:
    """The sessions of ``merging_sessions`` without lateness: each fires once, rows behind a closed session are dropped."""
    return merging_sessions(df, keys, ts_ms, order, gap_ms, delay_ms, 0, **folds)[0]


def walk_stretches(seen: DataFrame, keys: list[str], ts_ms: str, order: list[str], gap_ms: int, lateness_ms: int, folds: dict) -> tuple[DataFrame, DataFrame]:
    """As ``merging_sessions`` for rows with ``_stretch``, ``wm_before`` and the values of the folds."""
    group = [*keys, "_stretch"]
    # A session that has fired or closed ends at wm + 1 or before; only a row up to there can have met or missed one.
    behind = F.coalesce(F.col(ts_ms) <= F.col("wm_before") + F.lit(1), F.lit(False))
    names = {k: f"_own_{i}" for i, k in enumerate(group)}
    walked = checkpointed(seen.where(behind).select(*group).distinct()).withColumnsRenamed(names)
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    values = [f"_fold_{name}" for name in folds]
    calm = (
        seen.join(walked, same, "left_anti")
        .groupBy(*group)
        .agg(F.min(ts_ms).alias("_first"), F.max(ts_ms).alias("_last"), *[MERGE[kind](f"_fold_{name}").alias(f"_fold_{name}") for name, (kind, _) in folds.items()])
    )
    told = checkpointed(
        walk(seen.join(walked, same, "left_semi"), group, ts_ms, order, gap_ms, lateness_ms, [kind for kind, _ in folds.values()], values)
    )
    fired = calm.select(*keys, "_first", "_last", *values).unionByName(told.where(F.col("_kind") == FIRE).select(*keys, "_first", "_last", *values))
    firings = fired.select(
        *keys, F.col("_first").alias("session_start_ms"), (F.col("_last") + F.lit(gap_ms)).alias("session_end_ms"), *[F.col(f"_fold_{n}").alias(n) for n in folds]
    )
    aside = told.where(F.col("_kind") == ASIDE_ROW).select(*keys, *[c for c in order if c not in keys], F.col("_first").alias(ts_ms))
    return firings, aside


def walk(
    rows: DataFrame, group: list[str], ts_ms: str, order: list[str], gap_ms: int, lateness_ms: int, kinds: list[str], values: list[str], until: str | None = None
) -> DataFrame:
    """``group, order, _kind, _first, _last, _fired, values`` for rows with ``wm_before``.

    Kind ``fire``: a firing; ``aside``: a dropped row, at ``_first``, with its order columns; ``open`` (only with ``until``): a session left open.
    ``until`` names a column with the watermark after the last row of the group; without it everything fires at the end. Rows with ``_open``
    true are sessions left open before, with ``_first``, ``_last``, ``_fired``; they come before other rows.
    """
    extra = [c for c in order if c not in group]
    carried = [c for c in ("_open", "_first", "_last", "_fired") if c in rows.columns]
    columns = [*group, *extra, ts_ms, "wm_before", *values, *carried, *([until] if until else [])]
    columns = list(dict.fromkeys(columns))
    at = {c: i for i, c in enumerate(columns)}
    first = [F.desc("_open")] if "_open" in carried else []
    sorted_rows = rows.select(*columns).repartition(*group).sortWithinPartitions(*group, *first, *order)
    schema = T.StructType([*[rows.schema[c] for c in [*group, *extra]], T.StructField("_kind", T.StringType())])
    for name in ("_first", "_last"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("_fired", T.BooleanType())
    for name in values:
        schema = schema.add(name, rows.schema[name].dataType)
    none = (None,) * len(extra)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        key, sessions, end = None, [], None
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns]):
                own = row[: len(group)]
                if own != key:
                    if key is not None:
                        yield from ((*key, *none, *e) for e in _close(sessions, end, gap_ms, lateness_ms))
                    key, sessions = own, []
                end = row[at[until]] if until else NEVER
                given = [row[at[v]] for v in values]
                if carried and row[at["_open"]]:
                    sessions.append([row[at["_first"]], row[at["_last"]], row[at["_fired"]], given])
                    continue
                if row[at[ts_ms]] is None:
                    continue  # stands for a group without rows
                due, sessions = _pass(sessions, row[at["wm_before"]], gap_ms, lateness_ms)
                told, sessions, kept = _accept(sessions, row[at[ts_ms]], given, row[at["wm_before"]], gap_ms, lateness_ms, kinds)
                yield from ((*key, *none, FIRE, *e) for e in due + told)
                if not kept:
                    yield (*key, *[row[at[c]] for c in extra], ASIDE_ROW, row[at[ts_ms]], row[at[ts_ms]], None, *given)
        if key is not None:
            yield from ((*key, *none, *e) for e in _close(sessions, end, gap_ms, lateness_ms))

    return sorted_rows.mapInArrow(_arrow(run, schema), schema)


def _shown(session: list) -> tuple:
    first, last, fired, values = session
    return (first, last, fired, *values)


def _pass(sessions: list, watermark: int | None, gap: int, lateness: int) -> tuple[list, list]:
    """(firings that the watermark makes due, sessions still open)."""
    if watermark is None or not sessions:
        return [], sessions
    due = [s for s in sessions if not s[2] and s[1] + gap - 1 <= watermark]
    for session in due:
        session[2] = True
    return [_shown(s) for s in due], [s for s in sessions if s[1] + gap - 1 + lateness > watermark]


def _accept(sessions: list, ts: int, given: list, watermark: int | None, gap: int, lateness: int, kinds: list[str]) -> tuple[list, list, bool]:
    """(firings, sessions, whether the row was kept)."""
    met = [s for s in sessions if s[0] <= ts + gap and s[1] + gap >= ts]
    if not met and watermark is not None and ts + gap - 1 + lateness <= watermark:
        return [], sessions, False
    values = list(given)
    for other in met:
        values = [b if a is None else a if b is None else _FOLD[k](a, b) for k, a, b in zip(kinds, values, other[3])]
    merged = [min([ts, *[s[0] for s in met]]), max([ts, *[s[1] for s in met]]), False, values]
    told = []
    if watermark is not None and merged[1] + gap - 1 <= watermark:
        merged[2] = True
        told = [_shown(merged)]
    return told, [*[s for s in sessions if not any(s is m for m in met)], merged], True


def _close(sessions: list, watermark: int | None, gap: int, lateness: int) -> Iterator[tuple]:
    due, left = _pass(sessions, watermark, gap, lateness)
    yield from ((FIRE, *e) for e in due)
    if watermark != NEVER:
        yield from ((OPEN, *_shown(s)) for s in left)


def _arrow(run, schema: T.StructType, size: int = 10_000):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for row in run(batches):
            held.append(row)
            if len(held) == size:
                yield _batch(held, arrow)
                held = []
        if held:
            yield _batch(held, arrow)

    return task


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
