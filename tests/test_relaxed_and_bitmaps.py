"""Relaxed sequences, bitmaps of distinct numbers and unmatched rows within an interval, against plain versions."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewater import operators as op
from tidewater.operators import pointers


def matches(rows, steps, within, skip):
    out = Counter()
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[2], r[1]))
        after = -1
        for i, row in enumerate(own):
            if i <= after or not steps[0](row):
                continue
            at = i
            for step in steps[1:]:
                at = next((j for j in range(at + 1, len(own)) if step(own[j])), None)
                if at is None:
                    break
            if at is not None and (within is None or own[at][2] - row[2] < within):
                out[key, row[2], own[at][2]] += 1
                after = at if skip == "past_last" else after
    return out


@pytest.mark.parametrize("skip", ["none", "past_last"])
@pytest.mark.parametrize("hot", [10**6, 20])
def test_relaxed_sequence(spark, settings, monkeypatch, skip, hot):
    monkeypatch.setattr(pointers, "BLOCK_BITS", 3)
    settings(hotRows=hot, chunkRows=15, chunkBits=3)
    draw = random.Random(hot)
    rows = [(draw.choice(["a", "a", "a", "b", None]), k, draw.randrange(150), draw.choice("xyzw")) for k in range(220)]
    df = spark.createDataFrame(rows, "k string, seq bigint, at bigint, e string").withColumn("ts", F.timestamp_seconds("at"))
    for within in (None, 20):
        steps = [F.col("e") == "x", F.col("e").isin("y", "x"), F.col("e") == "z"]
        want = matches(rows, [lambda r: r[3] == "x", lambda r: r[3] in "yx", lambda r: r[3] == "z"], within, skip)
        got = op.match_relaxed_sequence(df, ["k"], ["ts", "seq"], "ts", steps, within and within * 1000, skip)
        assert Counter((r.k, int(r.first_ts.timestamp()), int(r.last_ts.timestamp())) for r in got.collect()) == want and want
    one = op.match_relaxed_sequence(df, ["k"], ["ts", "seq"], "ts", [F.col("e") == "w"], None, skip)
    assert one.count() == sum(r[3] == "w" for r in rows)


def test_relaxed_sequence_wants_a_known_rule(spark):
    with pytest.raises(ValueError):
        op.match_relaxed_sequence(spark.range(1), [], ["id"], "id", [F.lit(True)], None, "other")


def test_bitmaps_of_numbers(spark):
    draw = random.Random(2)
    rows = [(draw.choice("ab"), draw.randrange(3000), draw.choice([None, -1, 0, draw.randrange(50), draw.randrange(10**6), 2**62])) for _ in range(800)]
    df = spark.createDataFrame([*rows, ("a", None, 3)], "k string, at bigint, n bigint").repartition(4)
    panes = op.pane_bitmaps(df, ["k"], "at", "n", 100)
    got = {(r.k, r.pane_start_ms): r.uv for r in op.distinct_from(panes, ["k", "pane_start_ms"]).collect()}
    want = {}
    for k, at, n in rows:
        if n is not None:
            want.setdefault((k, at // 100 * 100), set()).add(n)
    assert got == {g: len(s) for g, s in want.items()}
    sliding = {}
    for (k, at), s in want.items():
        for start in range(at - 200, at + 1, 100):
            sliding.setdefault(start, set()).update(s)
    rolled = op.distinct_from(op.merge_bitmaps(op.roll_up(panes, ["k"], 300, 100), ["win_start_ms"]), ["win_start_ms"], "n")
    assert {r.win_start_ms: r.n for r in rolled.collect()} == {s: len(x) for s, x in sliding.items()}
    assert op.distinct_from(op.merge_bitmaps(panes, []), []).first()["uv"] == len(set().union(*want.values()))


def test_dense_ids(spark, split_everything):
    df = spark.createDataFrame([("x",), ("é",), (None,), ("x",), ("",), ("z" * 900,)], "name string")
    numbered = {r.name: r.number for r in op.dense_ids(df, "name", "number").collect()}
    assert numbered.pop(None) is None and sorted(numbered.values()) == [1, 2, 3, 4]
    assert op.dense_ids(df.limit(0), "name", "number").count() == 0


@pytest.mark.parametrize("lower, upper", [(-5, 5), (2, 9), (0, 0), (-7, -1)])
def test_unmatched_within(spark, lower, upper):
    draw = random.Random(upper)
    side = lambda n: [(draw.choice([1, 1, 2, None]), draw.choice([None, *range(60)]), k) for k in range(n)]
    left, right = side(70), side(40)
    frame = lambda rows: spark.createDataFrame(rows, "k long, at long, id long").select("k", "id", F.timestamp_seconds("at").alias("ts"))
    met = [(a[2], b[2]) for a in left for b in right if a[0] is not None and a[0] == b[0] and None not in (a[1], b[1]) and a[1] + lower <= b[1] <= a[1] + upper]
    got = op.unmatched_within(frame(left), frame(right), "k", "ts", "ts", lower * 1000, upper * 1000)
    assert sorted(r.id for r in got[0].collect()) == sorted({r[2] for r in left} - {a for a, _ in met})
    assert sorted(r.id for r in got[1].collect()) == sorted({r[2] for r in right} - {b for _, b in met})
