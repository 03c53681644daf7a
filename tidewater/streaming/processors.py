"""Per-key state on streams, for ``groupBy(key).transformWithState(...)``.

Each processor sees the rows of one key in a micro-batch together and brings them into arrival order (``seq``) first; the
size of a micro-batch is bounded by the source's own options. State is read once and written once per key and
micro-batch, because every access crosses from the Python worker to the JVM. Side outputs are rows whose ``route``
column is ``side``.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewater.functions.layout import layout

MAIN, SIDE = "main", "side"


def apply_stateful(
    df: DataFrame, keys: list[str], processor: Emitting, mode: str = "append", time: str = "none", seed: DataFrame | None = None
) -> DataFrame:
    """Run ``processor`` per key; ``time`` is none, processingTime or eventTime.

    ``seed`` is state to begin with, at most one row per key: the ``keys`` and the state fields of a ``KeyedProcessor``, from
    ``snapshots.state_of`` or aggregated from a table. It is read in the first micro-batch of a new checkpoint only, which also fixes
    the number of partitions, so this is the way to change that number.
    """
    schema = T.StructType([*[df.schema[k] for k in keys], *layout(processor.output)])
    processor.row = Row(*schema.names)
    if seed is None:
        return df.groupBy(*keys).transformWithState(processor, schema, mode, time)
    if not isinstance(processor, KeyedProcessor):
        raise TypeError("only the state of a KeyedProcessor can be seeded")
    held = layout(processor.state)
    first = seed.select(*(F.col(k).cast(df.schema[k].dataType) for k in keys), *(F.col(f.name).cast(f.dataType) for f in held))
    return df.groupBy(*keys).transformWithState(processor, schema, mode, time, first.groupBy(*keys))


class Emitting(StatefulProcessor):
    """A processor whose result rows are the key followed by the ``output`` layout."""

    output: str
    row: Row

    def emit(self, key: tuple, *values: Any) -> Row:
        return self.row(*key, *values)

    def close(self) -> None:
        pass


class KeyedProcessor(Emitting):
    """Base: ``state`` is a layout, ``step`` handles the ordered rows of a key.

    ``step(state, rows, now)`` returns ``(new state or None to keep nothing, output tuples)``.
    """

    state: str
    seq = "seq"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", layout(self.state))

    def ordered(self, rows: Iterator[Row]) -> list[Row]:
        return sorted(rows, key=lambda r: r[self.seq])

    def read(self) -> tuple | None:
        return self.held.get() if self.held.exists() else None

    def write(self, state: tuple | None) -> None:
        if state is None:
            self.held.clear()
        else:
            self.held.update(tuple(state))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        state, out = self.step(self.read(), self.ordered(rows), timerValues)
        self.write(state)
        for values in out:
            yield self.emit(key, *values)

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        self.write(tuple(initialState)[-len(layout(self.state)) :])

    def step(self, state: tuple | None, rows: list[Row], now: Any) -> tuple[tuple | None, list[tuple]]:
        raise NotImplementedError


class Reducing:
    """State that folds every added value into one, on a value state."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, schema: str, fold):
        self.held = handle.getValueState(name, layout(schema))
        self.fold = fold

    def get(self) -> tuple | None:
        return self.held.get() if self.held.exists() else None

    def add(self, value: tuple) -> tuple:
        current = self.get()
        merged = value if current is None else self.fold(current, value)
        self.held.update(merged)
        return merged

    def clear(self) -> None:
        self.held.clear()


class Aggregating(Reducing):
    """State with an accumulator apart from input and result."""

    def __init__(self, handle, name: str, schema: str, create, add, result):
        super().__init__(handle, name, schema, add)
        self.create, self.result = create, result

    def add(self, value: Any) -> None:
        current = self.held.get() if self.held.exists() else self.create()
        self.held.update(self.fold(current, value))

    def get(self) -> Any:
        return self.result(self.held.get()) if self.held.exists() else None


class RunningTotals(KeyedProcessor):
    """Per row: count, sum and average of the key so far."""

    output = "seq bigint, n bigint, total double, average double"
    state = "n bigint, total double"

    def __init__(self, value: str):
        self.value = value

    def step(self, state, rows, now):
        n, total = state or (0, 0.0)
        out = []
        for r in rows:
            n, total = n + 1, total + r[self.value]
            out.append((r.seq, n, total, total / n))
        return (n, total), out


class JumpAlarm(KeyedProcessor):
    """Every row on the main route; on the side route the rows that differ from the previous value by the limit."""

    output = "route string, seq bigint, value double, previous double"
    state = "previous double"

    def __init__(self, value: str, limit: float):
        self.value, self.limit = value, limit

    def step(self, state, rows, now):
        previous = state[0] if state else None
        out = []
        for r in rows:
            value = r[self.value]
            if previous is not None and abs(value - previous) >= self.limit:
                out.append((SIDE, r.seq, value, previous))
            out.append((MAIN, r.seq, value, previous))
            previous = value
        return (previous,), out


class RunningTop(KeyedProcessor):
    """Per row: the best ``n`` rows so far, one output row per rank. State never exceeds ``n`` entries."""

    output = "seq bigint, rank bigint, top_seq bigint, top_value double"
    state = "top_values array<double>, top_seqs array<bigint>"

    def __init__(self, n: int, value: str):
        self.n, self.value = n, value

    def step(self, state, rows, now):
        best = list(zip(*state)) if state else []
        out = []
        for r in rows:
            best = heapq.nsmallest(self.n, [*best, (r[self.value], r.seq)], key=lambda e: (-e[0], e[1]))
            out += [(r.seq, rank, seq, value) for rank, (value, seq) in enumerate(best, 1)]
        return ([value for value, _ in best], [seq for _, seq in best]), out


class DedupFirst(Emitting):
    """The first row of every value within a key, kept in a map state."""

    output = "value double, seq bigint"

    def __init__(self, value: str):
        self.value = value

    def init(self, handle):
        self.seen = handle.getMapState("seen", layout("value double"), layout("seq bigint"))

    def handleInputRows(self, key, rows, timerValues):
        first: dict = {}
        for r in rows:
            value = r[self.value]
            first[value] = min(first.get(value, r.seq), r.seq)
        for value, seq in sorted(first.items(), key=lambda e: e[1]):  # one state access per distinct value
            if not self.seen.containsKey((value,)):
                self.seen.updateValue((value,), (seq,))
                yield self.emit(key, value, seq)


class CountWindow(KeyedProcessor):
    """On every ``slide``-th row, the sum over the last ``size`` rows. With ``slide == size`` these are full blocks."""

    output = "seq bigint, n bigint, total double"
    state = "n bigint, recent array<double>"

    def __init__(self, value: str, size: int, slide: int | None = None):
        self.value, self.size, self.slide = value, size, slide or size

    def step(self, state, rows, now):
        n, recent = (state[0], list(state[1])) if state else (0, [])
        out = []
        for r in rows:
            n += 1
            recent = [*recent, r[self.value]][-self.size :]
            if n % self.slide == 0:
                out.append((r.seq, len(recent), sum(recent)))
        return (n, recent), out


class RetractCount(KeyedProcessor):
    """A running count as withdrawals and additions."""

    output = "is_add boolean, seq bigint, cnt bigint"
    state = "n bigint"

    def step(self, state, rows, now):
        n = state[0] if state else 0
        out = []
        for r in rows:
            if n:
                out.append((False, r.seq, n))
            n += 1
            out.append((True, r.seq, n))
        return (n,), out


class ChangelogAggregate(Emitting):
    """Count, sum, least and greatest value of what a log of additions and withdrawals (``is_add``) leaves: ``aggregate_changelog`` on streams.

    One row per key and micro-batch with the state after it. Values are kept with their net count in a map; only when the last of
    the least or greatest value goes are the others looked through.
    """

    output = "n bigint, total double, low double, high double"

    def __init__(self, value: str, is_add: str = "is_add"):
        self.value, self.is_add = value, is_add

    def init(self, handle):
        self.held = handle.getMapState("held", layout("value double"), layout("net bigint"))
        self.sums = handle.getValueState("sums", layout("n bigint, total double, low double, high double"))

    def handleInputRows(self, key, rows, timerValues):
        changes: dict[float, int] = {}
        for r in rows:
            value = float(r[self.value])
            changes[value] = changes.get(value, 0) + (1 if r[self.is_add] else -1)
        n, total, low, high = self.sums.get() if self.sums.exists() else (0, 0.0, None, None)
        gone = False
        for value, change in changes.items():
            if not change:
                continue
            before = self.held.getValue((value,))[0] if self.held.containsKey((value,)) else 0
            after = before + change
            n, total = n + change, total + value * change
            if after:
                self.held.updateValue((value,), (after,))
            else:
                self.held.removeKey((value,))
            if after > 0:
                low, high = (value, value) if low is None else (min(low, value), max(high, value))
            elif before > 0 and value in (low, high):
                gone = True
        if gone:
            there = [k[0] for k, v in self.held.iterator() if v[0] > 0]
            low, high = (min(there), max(there)) if there else (None, None)
        self.sums.update((n, total, low, high))
        yield self.emit(key, n, total, low, high)


class RowTimer(Emitting):
    """Passes rows on and fires a timer ``after_ms`` after each, on the clock the query was given.

    With event time the timer counts from the row's ``ts``; equal timers of a key fire once.
    """

    output = "route string, at_ms bigint"

    def __init__(self, after_ms: int, event_time: str | None = None):
        self.after, self.event_time = after_ms, event_time

    def init(self, handle):
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues):
        for r in rows:
            if self.event_time:
                at = to_millis(r[self.event_time])
            else:
                at = timerValues.getCurrentProcessingTimeInMs()
            self.handle.registerTimer(at + self.after)
            yield self.emit(key, MAIN, at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield self.emit(key, SIDE, expiredTimerInfo.getExpiryTimeInMs())


class Waiting(Emitting):
    """Rows wait in a list state until the watermark has passed them and are then worked off in order of ``(ts, seq)``.

    So rows that arrive in a later batch but within the watermark's delay still find their place. A key has one timer at
    a time for this, at the newest row that waited when it was set; ``waiting`` is the layout of what a row keeps, starting
    with ``at_ms bigint, seq bigint``. What waits is bounded by the rows of the delay.
    """

    waiting: str

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.queue = handle.getListState("waiting", layout(self.waiting))
        self.due = handle.getValueState("due", layout("at_ms bigint"))

    def kept(self, row: Row) -> tuple:
        raise NotImplementedError

    def work(self, key: tuple, rows: list[tuple], passed: int) -> Iterator[Row]:
        """Handle the ordered rows up to the instant ``passed``; there may be none."""
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues):
        fresh = [(to_millis(r.ts), r.seq, *self.kept(r)) for r in rows]
        self.queue.appendList(fresh)
        if not self.due.exists():
            self._set_timer(fresh)
        return iter([])

    def _set_timer(self, rows):
        newest = max(r[0] for r in rows)
        self.handle.registerTimer(newest)
        self.due.update((newest,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        rows = [tuple(r) for r in self.queue.get()] if self.queue.exists() else []
        ready = sorted((r for r in rows if r[0] <= passed), key=lambda r: r[:2])
        left = [r for r in rows if r[0] > passed]
        if left:
            self.queue.put(left)
            if ready or not self.due.exists():
                self._set_timer(left)
        else:
            self.queue.clear()
            self.due.clear()
        yield from self.work(key, ready, passed)


class NoDropAlarm(Waiting):
    """Alarm when a key's value has not dropped below its baseline for ``wait_ms`` (see the batch operator).

    With event time, rows are walked in order of time and arrival once the watermark has passed them, and timers that expire
    before the next row are settled on the way; one real timer covers the silence after the last row. With processing time
    rows are walked as they come and the clock is the task's.
    """

    output = "route string, at_ms bigint, value double"
    waiting = "at_ms bigint, seq bigint, value double"

    def __init__(self, value: str, wait_ms: int, event_time: bool = True):
        self.value, self.wait, self.event_time = value, wait_ms, event_time

    def init(self, handle):
        super().init(handle)
        self.held = handle.getValueState("held", layout("baseline double, timer bigint"))

    def kept(self, row):
        return (row[self.value],)

    def handleInputRows(self, key, rows, timerValues):
        if self.event_time:
            return super().handleInputRows(key, rows, timerValues)
        now = timerValues.getCurrentProcessingTimeInMs()
        return self._walk(key, [(now, r.seq, r[self.value]) for r in sorted(rows, key=lambda r: r.seq)], None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.event_time:
            yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)
        else:
            yield from self._walk(key, [], expiredTimerInfo.getExpiryTimeInMs())

    def work(self, key, rows, passed):
        return self._walk(key, rows, passed)

    def _walk(self, key, rows, passed):
        baseline, timer = self.held.get() if self.held.exists() else (None, None)
        registered = timer
        for at, _, value in rows:
            if timer is not None and at >= timer:
                yield self.emit(key, SIDE, timer, baseline)
                timer = None
            if baseline is not None and value < baseline:
                baseline, timer = value, None
            elif timer is None:
                baseline, timer = value, at + self.wait
            yield self.emit(key, MAIN, at, value)
        if timer is not None and passed is not None and timer <= passed:
            yield self.emit(key, SIDE, timer, baseline)
            timer = None
        if timer is not None and timer != registered:
            self.handle.registerTimer(timer)
        if baseline is not None:
            self.held.update((baseline, timer))


class MatchSequence(Waiting):
    """``flags`` true on consecutive rows of a key, one flag per step, within less than ``within_ms`` from first to last.

    Only the last ``len(flags) - 1`` rows are carried further. ``within_ms=None`` sets no limit.
    """

    output = "first_ms bigint, last_ms bigint"
    waiting = "at_ms bigint, seq bigint, flags array<boolean>"

    def __init__(self, flags: list[str], within_ms: int | None = None):
        self.flags, self.within = flags, within_ms

    def init(self, handle):
        super().init(handle)
        self.recent = handle.getListState("recent", layout(self.waiting))

    def kept(self, row):
        return ([bool(row[f]) for f in self.flags],)

    def counts(self, row: tuple) -> bool:
        """Whether the row takes part."""
        return True

    def work(self, key, rows, passed):
        steps = len(self.flags)
        window = [tuple(r) for r in self.recent.get()] if self.recent.exists() else []
        for row in rows:
            if not self.counts(row):
                continue
            window = [*window, row][-steps:]
            full = len(window) == steps and all(r[2][k] for k, r in enumerate(window))
            if full and (self.within is None or row[0] - window[0][0] < self.within):
                yield self.emit(key, window[0][0], row[0])
        window = window[1 - steps :] if steps > 1 else []
        self.recent.put(window) if window else self.recent.clear()


class MatchTimes(MatchSequence):
    """One ``flag`` true on ``times`` rows of a key; without ``consecutive`` other rows may lie in between."""

    def __init__(self, flag: str, times: int, within_ms: int, consecutive: bool = True):
        super().__init__([flag] * times, within_ms)
        self.consecutive = consecutive

    def counts(self, row):
        return self.consecutive or row[2][0]


class MatchRelaxed(Waiting):
    """``flags`` true in this order on rows of a key, other rows in between: what ``match_relaxed_sequence`` gives.

    Kept are the open matches: the time of their first row and the step they wait for. ``within_ms`` drops those that can no longer end in time;
    without it they wait for good. ``skip="past_last"``: the row that ends a match discards all open ones and starts none.
    """

    output = "first_ms bigint, last_ms bigint"
    waiting = "at_ms bigint, seq bigint, flags array<boolean>"

    def __init__(self, flags: list[str], within_ms: int | None = None, skip: str = "none"):
        self.flags, self.within, self.skip = flags, within_ms, skip

    def init(self, handle):
        super().init(handle)
        self.open = handle.getListState("open", layout("first_ms bigint, step bigint"))

    def kept(self, row):
        return ([bool(row[f]) for f in self.flags],)

    def work(self, key, rows, passed):
        waiting = [tuple(r) for r in self.open.get()] if self.open.exists() else []
        for at, _, flags in rows:
            if self.within is not None:
                waiting = [w for w in waiting if at - w[0] < self.within]
            moved, ended = [], False
            for first, step in waiting:
                if not flags[step]:
                    moved.append((first, step))
                elif step + 1 < len(self.flags):
                    moved.append((first, step + 1))
                elif not (ended and self.skip == "past_last"):
                    ended = True
                    yield self.emit(key, first, at)
            if ended and self.skip == "past_last":
                waiting = []
                continue
            if flags[0]:
                if len(self.flags) == 1:
                    yield self.emit(key, at, at)
                else:
                    moved.append((at, 1))
            waiting = moved
        self.open.put(waiting) if waiting else self.open.clear()


class Reconcile(Emitting):
    """Two sides of one key (column ``side`` = left/right, JSON in ``body``): every pair is emitted once both have arrived.

    As in the batch join, repeats pair with every row of the other side. Rows are kept for ``keep_ms`` of processing
    time (the query then needs ``time="processingTime"``); without it they are kept for good.
    """

    output = "left_body string, right_body string"

    def __init__(self, keep_ms: int | None = None):
        self.keep = keep_ms

    def init(self, handle):
        text = layout("body string")
        self.sides = {name: handle.getListState(name, text, self.keep) for name in ("left", "right")}

    def handleInputRows(self, key, rows, timerValues):
        fresh: dict[str, list[str]] = {"left": [], "right": []}
        for r in sorted(rows, key=lambda r: r.seq):
            fresh[r.side].append(r.body)
        old = {name: [r[0] for r in state.get()] if state.exists() else [] for name, state in self.sides.items()}
        for name, bodies in fresh.items():
            if bodies:
                self.sides[name].appendList([(body,) for body in bodies])
        for left in old["left"]:
            for right in fresh["right"]:
                yield self.emit(key, left, right)
        for left in fresh["left"]:
            for right in [*old["right"], *fresh["right"]]:
                yield self.emit(key, left, right)


def to_millis(ts) -> int:
    """Epoch milliseconds of a time stamp as Spark hands it to Python, or of a number that already is that."""
    if hasattr(ts, "timestamp"):
        from datetime import timezone

        aware = ts if ts.tzinfo else ts.astimezone(timezone.utc)
        return round(aware.timestamp() * 1_000_000) // 1000
    return int(ts)


def tagged(left: DataFrame, right: DataFrame, key: str, seq: Column | str) -> DataFrame:
    """Both sides as ``key, side, seq, body`` for ``Reconcile``."""

    def side(df: DataFrame, name: str) -> DataFrame:
        order = F.col(seq) if isinstance(seq, str) else seq
        return df.select(
            key, F.lit(name).alias("side"), order.cast("bigint").alias("seq"), F.to_json(F.struct(*df.columns)).alias("body")
        )

    return side(left, "left").unionByName(side(right, "right"))
