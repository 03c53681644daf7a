"""Removal of repeated byte strings by column-wise construction of a multi-text Burrows-Wheeler order.

Every window of ``length`` bytes chooses one of its ``ANCHOR``-byte strings by content alone (the least hash, leftmost), so
equal windows choose equal anchors at equal places. Windows that share an anchor occurrence form one context of at most
``2 * length - ANCHOR`` bytes. Anchors that occur once are done. Contexts of the same anchor are laid under each other and
their suffix order is built column by column from the right: each round inserts one symbol of every context, sorts stably
by it, and updates the common prefixes of neighbours from the round before. A common prefix of ``length`` bytes
marks the window as repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import Rolling, byte_column, chunks, discard, durable, owners

LENGTH = 200
ANCHOR = 32
#: Distinct contexts of one anchor that are ordered in one task; larger groups are counted window by window instead.
GROUP = 20_000
#: Contexts ordered at once, and bytes of them held at once.
BATCH = 15_000

_ABSENT = 256


def anchors(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """(text, anchor hash, context hash, place, first window, last window) of all anchor occurrences, places within texts."""
    empty = np.zeros(0, np.int64)
    places = length - anchor + 1
    if len(data) < length:
        return (empty,) * 6
    rolling = Rolling(data)
    at = np.arange(len(data) - anchor + 1)
    hashes = rolling.of(at, at + anchor)
    order = (hashes & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    rows = -(-len(order) // places)
    padded = np.full(rows * places, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(order)] = order
    blocks = padded.reshape(rows, places)
    to_here = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    from_here = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    starts = len(data) - length + 1
    chosen = np.minimum(from_here[:starts], to_here[places - 1 : places - 1 + starts]) & np.uint64(0xFFFFFFFF)
    lengths = np.diff(bounds)
    usable = np.maximum(lengths - length + 1, 0)
    text = owners(np.append(0, np.cumsum(usable)))
    if not len(text):
        return (empty,) * 6
    window = np.arange(len(text)) - np.repeat(np.cumsum(usable) - usable, usable) + bounds[:-1][text]
    place = chosen[window].astype(np.int64)
    new = np.append(True, (place[1:] != place[:-1]) | (text[1:] != text[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    low, high, owner = window[first], window[last], text[first]
    spot = place[first]
    context = rolling.of(low, high + length)
    base = bounds[:-1][owner]
    return owner, hashes[spot].view(np.int64), context.view(np.int64), spot - base, low - base, high - base


def _find(length: int, anchor: int):
    def run(batches):
        for batch in batches:
            data, bounds = byte_column(batch.column(1))
            for a, z in chunks(bounds):
                owner, *rest = anchors(data[bounds[a] : bounds[z]], bounds[a : z + 1] - bounds[a], length, anchor)
                if len(owner):
                    hashes, context, at, low, high = rest
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(owner + a)), pa.array(hashes), pa.array(context), pa.array(at), pa.array(low), pa.array(high)],
                        ["key", "anchor", "context", "at", "low", "high"],
                    )

    return run


def repeated_windows(
    group: np.ndarray, symbols: np.ndarray, first: np.ndarray, last: np.ndarray, length: int
) -> np.ndarray:
    """For aligned contexts, whether the window at each column also occurs in another context of the group.

    ``symbols[r]`` holds the bytes of context ``r`` from column ``first[r]`` to ``last[r] + length`` and ``_ABSENT``
    elsewhere; ``group`` is sorted. Windows of context ``r`` start in columns ``first[r]`` to ``last[r]``.
    """
    n, columns = symbols.shape
    marked = np.zeros((n, columns - length + 1), bool)
    order = np.arange(n)
    common = np.zeros(n + 1, np.int32)  # with the context before in the order; one place of padding
    short = group.astype(np.uint16)
    for column in range(columns - 1, -1, -1):
        symbol = symbols[order, column]
        moved = np.argsort(symbol, kind="stable")
        moved = moved[np.argsort(short[order[moved]], kind="stable")]
        order, symbol = order[moved], symbol[moved]
        same = (group[order[1:]] == group[order[:-1]]) & (symbol[1:] == symbol[:-1]) & (symbol[1:] != _ABSENT)
        pairs = np.flatnonzero(same)
        fresh = np.zeros(n + 1, np.int32)
        if len(pairs):
            ranges = np.empty(2 * len(pairs), np.int64)
            ranges[0::2] = moved[pairs] + 1
            ranges[1::2] = moved[pairs + 1] + 1
            fresh[pairs + 1] = np.minimum.reduceat(common, ranges)[0::2] + 1
        common = fresh
        if column < marked.shape[1]:
            long = common >= length
            hit = long[:-1] | long[1:]
            marked[order, column] = hit & (first[order] <= column) & (column <= last[order])
    return marked


def _ordered(length: int, anchor: int):
    """Repeated stretches of each context; rows come sorted by (anchor, context), whole groups in one partition."""
    left = length - anchor
    columns = left + length

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        names = {a: k for k, a in enumerate(dict.fromkeys(r[0] for r in rows))}
        group = np.array([names[r[0]] for r in rows])
        before, count = np.array([r[3] for r in rows]), np.array([r[2] for r in rows])
        width = np.array([len(r[4]) for r in rows])
        first = left - before
        symbols = np.full((len(rows), columns), _ABSENT, np.uint16)
        for k, row in enumerate(rows):
            symbols[k, first[k] : first[k] + width[k]] = np.frombuffer(row[4], np.uint8)
        last = first + width - length
        marked = repeated_windows(group, symbols, first, last, length)
        at = np.arange(marked.shape[1])
        marked |= (count > 1)[:, None] & (at >= first[:, None]) & (at <= last[:, None])
        spans = [_stretches(np.flatnonzero(m) - left, length) if m.any() else None for m in marked]
        keep = [k for k, s in enumerate(spans) if s]
        return _found([rows[k][0] for k in keep], [rows[k][1] for k in keep], [spans[k] for k in keep])

    def run(batches: Iterator[pa.RecordBatch]):
        rows: list[tuple] = []
        group_start, previous = 0, None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if previous and row[:2] == previous:
                    continue
                if previous and row[0] != previous[0]:
                    if len(rows) >= BATCH:
                        yield solve(rows)
                        rows = []
                previous = row[:2]
                rows.append(row)
        if rows:
            yield solve(rows)

    return run


def _stretches(starts: np.ndarray, length: int) -> list[dict]:
    """Byte ranges that windows at the sorted ``starts`` cover, joined where they touch or overlap."""
    cut = np.flatnonzero(np.diff(starts) > length)
    begin, end = starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)] + length
    return [{"begin": int(b), "end": int(e)} for b, e in zip(begin, end)]


_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_FOUND = "anchor long, context long, spans array<struct<begin: long, end: long>>"


def _found(anchor: list, context: list, spans: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor, pa.int64()), pa.array(context, pa.int64()), pa.array(spans, _SPANS)], ["anchor", "context", "spans"]
    )


def _cut_contexts(length: int):
    """The bytes of the contexts that a text stands for."""

    def run(batches):
        for batch in batches:
            data, bounds = byte_column(batch.column(0))
            wanted = batch.column(1).to_pylist()
            out = [[] for _ in range(5)]
            for k, contexts in enumerate(wanted):
                text = data[bounds[k] : bounds[k + 1]]
                for c in contexts:
                    for column, value in zip(
                        out, (c["anchor"], c["context"], c["n"], c["at"] - c["low"], text[c["low"] : c["high"] + length].tobytes())
                    ):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, kinds)], ["anchor", "context", "n", "before", "bytes"])

    return run


def _windows(length: int):
    """Every window of every context as (anchor, context, n, start relative to the anchor, two hashes)."""

    def run(batches):
        for batch in batches:
            for a, c, n, before, raw in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                starts = np.arange(len(raw) - length + 1)
                hashes = Rolling(np.frombuffer(raw, np.uint8)).of(starts, starts + length)
                size = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size, x)) for x in (a, c, n)] + [pa.array(starts - before), pa.array(hashes.view(np.int64))],
                    ["anchor", "context", "n", "start", "hash"],
                )

    return run


def _joined(length: int):
    def run(batches):
        for batch in batches:
            starts = batch.column(2).to_pylist()
            yield _found(batch.column(0).to_pylist(), batch.column(1).to_pylist(), [_stretches(np.unique(s), length) for s in starts])

    return run


def _kept(batches):
    for batch in batches:
        data, bounds = byte_column(batch.column(1))
        spans = batch.column(2).to_pylist()
        out = [[] for _ in range(4)]
        for k, ranges in enumerate(spans):
            raw = data[bounds[k] : bounds[k + 1]]
            depth = np.zeros(len(raw) + 1, np.int64)
            for r in ranges or ():
                depth[r["begin"]] += 1
                depth[r["end"]] -= 1
            gone = np.cumsum(depth)[:-1] > 0
            runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0]))
            for column, value in zip(out, (len(raw), int(gone.sum()), runs, raw[~gone].tobytes())):
                column.append(value)
        digests = [hashlib.sha256(kept).hexdigest() for kept in out[3]]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(o, pa.int64()) for o in out[:3]), pa.array(digests, pa.string()), batch.column(2)],
            ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """(key, spans) for every distinct text with repeated bytes, as a durable table; ``key`` is its MD5, spans are byte ranges,
    maybe overlapping."""
    anchor = min(ANCHOR, length)
    source = _keyed(docs, text)
    found = durable(
        source.mapInArrow(_find(length, anchor), "key binary, anchor long, context long, at long, low long, high long"), "anchors"
    )
    # Written, so that the join below sees two plain exchanges and can split the partition of a hot anchor.
    shared = durable(
        found.groupBy("anchor")
        .agg(F.count("*").alias("times"), F.min("context").alias("least"), F.max("context").alias("most"))
        .where("times > 1")
        .select("anchor", (F.col("least") == F.col("most")).alias("alike")),
        "shared",
    )
    repeated = durable(found.join(shared, "anchor"), "repeated")
    mixed = repeated.where("not alike")
    stands = mixed.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.struct("key", "at", "low", "high")).alias("one"))
    wanted = stands.groupBy("one.key").agg(
        F.collect_list(F.struct("anchor", "context", "n", "one.at", "one.low", "one.high")).alias("contexts")
    )
    contexts = durable(
        _distinct(source)
        .join(wanted, "key")
        .select("text", "contexts")
        .mapInArrow(_cut_contexts(length), "anchor long, context long, n long, before long, bytes binary"),
        "contexts",
    )
    sizes = durable(contexts.groupBy("anchor").agg(F.count("*").alias("size")), "sizes")
    small = contexts.join(sizes.where(F.col("size") <= group), "anchor").drop("size")
    large = contexts.join(sizes.where(F.col("size") > group), "anchor").drop("size")
    ordered = small.repartition("anchor").sortWithinPartitions("anchor", "context").mapInArrow(_ordered(length, anchor), _FOUND)
    windows = large.mapInArrow(_windows(length), "anchor long, context long, n long, start long, hash long")
    twice = windows.groupBy("anchor", "start", "hash").agg(F.sum("n").alias("times")).where("times > 1").drop("times")
    counted = (
        windows.join(twice, ["anchor", "start", "hash"])
        .groupBy("anchor", "context")
        .agg(F.collect_list("start").alias("starts"))
        .mapInArrow(_joined(length), _FOUND)
    )
    stretches = mixed.join(ordered.union(counted), ["anchor", "context"]).select("key", "at", F.explode("spans").alias("s"))
    spans = repeated.where("alike").select("key", F.struct(F.col("low").alias("begin"), (F.col("high") + length).alias("end")).alias("s"))
    spans = spans.union(
        stretches.select("key", F.struct((F.col("at") + F.col("s.begin")).alias("begin"), (F.col("at") + F.col("s.end")).alias("end")))
    )
    done = durable(spans.groupBy("key").agg(F.collect_set("s").alias("spans")), "spans")
    discard(found, shared, repeated, contexts, sizes)
    return done


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.unhex(F.md5(whole)).alias("key"), whole.alias("text"))


def _distinct(source: DataFrame) -> DataFrame:
    return source.groupBy("key").agg(F.first("text").alias("text"))


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) for every row of ``docs``.

    A byte goes if a string of ``length`` bytes that covers it starts at any other place, in this or another text; texts
    are judged as given, and strings never reach across texts. Null and empty texts have no bytes; texts shorter than
    ``length`` keep all. Repeated rows are copies of each other, so they lose everything from ``length`` bytes on. ``spans``
    are the removed byte ranges, unordered and maybe overlapping. An empty table gives an empty table.
    """
    spans = repeated_spans(docs, text, length, group)
    source = _keyed(docs, text)
    judged = (
        _distinct(source)
        .join(spans, "key", "left")
        .mapInArrow(
            _kept,
            "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<begin: long, end: long>>",
        )
    )
    ids = docs.select(F.col(id).alias("doc_id"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("key"))
    return ids.join(judged, "key").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
