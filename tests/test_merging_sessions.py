"""Merging sessions with lateness: columns and walk against a plain simulation of one stream, and the stream twin."""

import random

import pytest
from pyspark.sql import functions as F

from tidewater import operators as op
from tidewater.session import ship_package
from tidewater.streaming import LateSessions, drain

ROWS = "k long, at long, seq long, v long"


def simulate(rows, gap, delay, lateness):
    """One global watermark, moved after every row; every session as a list of its members' times and values."""
    sessions, fired, aside, peak = {}, [], [], None

    def show(key, s):
        fired.append((key, min(t for t, _ in s["rows"]), max(t for t, _ in s["rows"]) + gap, len(s["rows"]), sum(v or 0 for _, v in s["rows"]), max((v for _, v in s["rows"] if v is not None), default=None)))
        s["fired"] = True

    def advance(mark):
        for key, own in sessions.items():
            for s in list(own):
                end = max(t for t, _ in s["rows"]) + gap
                if not s["fired"] and end - 1 <= mark:
                    show(key, s)
                if end - 1 + lateness <= mark:
                    own.remove(s)

    for key, t, seq, v in sorted(rows, key=lambda r: r[2]):
        mark = None if peak is None else peak - delay - 1
        own = sessions.setdefault(key, [])
        near = [s for s in own if min(x for x, _ in s["rows"]) <= t + gap and max(x for x, _ in s["rows"]) + gap >= t]
        if not near and mark is not None and t + gap - 1 + lateness <= mark:
            aside.append((key, seq, t))
        else:
            merged = {"rows": [(t, v), *[r for s in near for r in s["rows"]]], "fired": False}
            own[:] = [s for s in own if all(s is not n for n in near)] + [merged]
            if mark is not None and max(x for x, _ in merged["rows"]) + gap - 1 <= mark:
                show(key, merged)
        peak = t if peak is None else max(peak, t)
        advance(peak - delay - 1)
    advance(10**15)
    return sorted(fired, key=repr), sorted(aside, key=repr)


def rows_of(seed, n, jitter):
    draw = random.Random(seed)
    rows, t = [], 0
    for seq in range(n):
        t += draw.choice([0, 1, 2, 3, 12])
        late = draw.choice([0, 0, 0, 1]) * draw.randrange(jitter)
        rows.append((draw.choice([1, 1, 1, 2, None]), max(0, t - late), seq, draw.choice([None, seq, seq])))
    return rows


def folds():
    return {"n": ("sum", F.lit(1).cast("bigint")), "total": ("sum", F.coalesce("v", F.lit(0)).cast("bigint")), "top": ("max", F.col("v"))}


def shown(frame):
    return sorted(map(tuple, frame.select("k", "session_start_ms", "session_end_ms", "n", "total", "top").collect()), key=repr)


@pytest.mark.parametrize("seed, gap, delay, lateness", [(1, 4, 3, 0), (2, 4, 3, 6), (3, 2, 0, 10), (4, 6, 1, 1), (5, 3, 8, 20)])
def test_batch_equals_simulation(spark, seed, gap, delay, lateness):
    rows = rows_of(seed, 250, 30)
    df = spark.createDataFrame([*rows, (1, None, 999, 5)], ROWS)
    firings, aside = op.merging_sessions(df, ["k"], "at", ["seq"], gap, delay, lateness, **folds())
    want = simulate(rows, gap, delay, lateness)
    assert shown(firings) == want[0]
    assert sorted(map(tuple, aside.select("k", "seq", "at").collect()), key=repr) == want[1]
    assert want[1] or lateness == 20


def test_bridge_between_fired_sessions(spark):
    """Two sessions fire, a late row bridges them: one firing of the merged session; a row behind the closed one is dropped."""
    rows = [(1, 0, 0, 1), (1, 8, 1, 1), (2, 20, 2, 1), (1, 4, 3, 1), (2, 60, 4, 1), (1, 5, 5, 1)]
    df = spark.createDataFrame(rows, ROWS)
    firings, aside = op.merging_sessions(df, ["k"], "at", ["seq"], 5, 0, 20, n=("sum", F.lit(1).cast("bigint")))
    assert sorted(map(tuple, firings.where("k = 1").select("session_start_ms", "session_end_ms", "n").collect())) == [(0, 5, 1), (0, 13, 3), (8, 13, 1)]
    assert [r["seq"] for r in aside.collect()] == [5]


def test_chunked_plans(spark, split_everything):
    rows = rows_of(9, 120, 25)
    firings, _ = op.merging_sessions(spark.createDataFrame(rows, ROWS), ["k"], "at", ["seq"], 4, 3, 5, **folds())
    assert shown(firings) == simulate(rows, 4, 3, 5)[0]


def test_rows_in_order_need_no_walk(spark):
    rows = [(k % 3, k, k, 1) for k in range(90)]
    firings, aside = op.merging_sessions(spark.createDataFrame(rows, ROWS), ["k"], "at", ["seq"], 2, 5, 0, **folds())
    assert shown(firings) == simulate(rows, 2, 5, 0)[0] and aside.count() == 0


@pytest.mark.parametrize("cuts", [(0, 40, 41, 120), (0, 60)])
def test_stream_twin_for_any_cut(spark, tmp_path, cuts):
    ship_package(spark)
    rows = rows_of(11, 150, 30) + [(-1, 10**6, 1000, 0)]
    df = spark.createDataFrame(rows, ROWS).cache()
    folder, memory = str(tmp_path / "in"), str(tmp_path / "memory")
    for low, high in zip(cuts, [*cuts[1:], 2000]):
        df.where(f"seq >= {low} and seq < {high}").coalesce(1).write.mode("append").parquet(folder)

    def sink(name):
        return lambda out, batch_id: out.write.mode("overwrite").parquet(str(tmp_path / name / f"batch={batch_id}"))

    twin = LateSessions(["k"], "at", ["seq"], 4, 3, 6, sink("fired"), sink("aside"), memory, **folds())
    read = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    drain(twin.attach(read), str(tmp_path / "cp"))
    fired, aside = simulate(rows, 4, 3, 6)
    assert shown(spark.read.parquet(str(tmp_path / "fired"))) == [f for f in fired if f[0] != -1]
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "aside")).select("k", "seq", "at").collect()), key=repr) == aside
