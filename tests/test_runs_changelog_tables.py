"""Functions over sorted runs, aggregates over a log of additions and withdrawals, table functions in SQL."""

import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewater import operators as op
from tidewater.functions.tables import register_table_functions
from tidewater.operators import runs
from tidewater.session import ship_package
from tidewater.streaming import apply_stateful, drain
from tidewater.streaming import processors as p


def test_walk_windows(spark):
    ship_package(spark)
    draw = random.Random(1)
    rows = [(draw.choice(["a", None]), draw.randrange(100), k, draw.choice([None, k])) for k in range(300)] + [("a", None, 1, 1)]
    df = spark.createDataFrame(rows, "k string, at bigint, seq bigint, v bigint").withColumn("ts", F.timestamp_seconds("at"))

    def first_three(key, start, given):
        """Stops early; two results for a window, none for windows that begin with NULL."""
        head = [v for (v,), _ in zip(given, range(3))]
        if head[0] is not None:
            yield head[0], len(head)
            yield head[-1], start

    got = op.walk_windows(df, ["k"], "ts", 10_000, ["seq"], ["v"], first_three, "v bigint, n bigint").collect()
    want = Counter()
    for key in ("a", None):
        for start in range(0, 100, 10):
            own = sorted((r[2], r[3]) for r in rows if r[0] == key and r[1] is not None and start <= r[1] < start + 10)[:3]
            if own and own[0][1] is not None:
                want[key, start * 1000, own[0][1], len(own)] += 1
                want[key, start * 1000, own[-1][1], start * 1000] += 1
    assert Counter(map(tuple, got)) == want
    empty = df.limit(0)
    assert op.walk_windows(empty, ["k"], "ts", 10_000, ["seq"], ["v"], first_three, "v bigint, n bigint").count() == 0


def test_a_window_is_never_held():
    """A window of 2 000 000 rows goes through in the memory of a few thousand."""

    def batches():
        for k in range(100):
            yield pa.RecordBatch.from_arrays([pa.array(["a"] * 20_000), pa.array([0] * 20_000), pa.array(range(k, k + 20_000))], ["k", "w", "v"])

    def total(key, start, rows):
        yield sum(v for (v,) in rows), 1

    tracemalloc.start()
    (only,) = runs._results(runs._tuples(batches()), 2, 3, total)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert only == ("a", 0, sum(k * 20_000 + 20_000 * 19_999 // 2 for k in range(100)), 1)
    assert peak < 20_000_000


def log(seed, n):
    """Additions and withdrawals, some withdrawn before they are added."""
    draw = random.Random(seed)
    out = []
    for k in range(n):
        key, value = draw.choice("abc"), float(draw.randrange(12))
        out.append((key, True, value))
        if draw.random() < 0.7:
            out.insert(draw.randrange(len(out) + 1), (key, False, value))
    out += [("gone", True, 1.0), ("gone", False, 1.0)]
    return [(*r, k) for k, r in enumerate(out)]


def direct(rows):
    held = {}
    for key, add, value, _ in rows:
        held.setdefault(key, Counter())[value] += 1 if add else -1
    out = {}
    for key, net in held.items():
        there = [v for v, n in net.items() if n > 0]
        if sum(net.values()) > 0:
            out[key] = (sum(net.values()), sum(v * n for v, n in net.items()), min(there), max(there))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_aggregate_changelog(spark, seed):
    rows = log(seed, 120)
    df = spark.createDataFrame(rows, "k string, is_add boolean, v double, seq bigint").repartition(3)
    got = {r.k: tuple(r)[1:] for r in op.aggregate_changelog(df, ["k"], "v").collect()}
    assert got == direct(rows) and "gone" not in got


def test_changelog_of_counts_gives_the_direct_aggregate(spark):
    draw = random.Random(4)
    rows = [(draw.randrange(9), k) for k in range(200)]
    changes = op.retract_count(spark.createDataFrame(rows, "user long, seq long"), ["user"], ["seq"])
    counts = Counter(u for u, _ in rows).values()
    assert tuple(op.aggregate_changelog(changes, [], "cnt").first()) == (len(counts), 200, min(counts), max(counts))


def test_changelog_on_a_stream(spark, tmp_path):
    ship_package(spark)
    rows = log(7, 150)
    df = spark.createDataFrame(rows, "k string, is_add boolean, v double, seq bigint")
    for part in range(4):
        df.where(f"seq % 4 = {part}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    read = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    last = {}

    def keep(batch, batch_id):
        last.update({r.k: tuple(r)[1:] for r in batch.collect()})

    out = apply_stateful(read, ["k"], p.ChangelogAggregate("v"), mode="update")
    drain(out.writeStream.outputMode("update").foreachBatch(keep), str(tmp_path / "cp"))
    assert {k: v for k, v in last.items() if v[0] > 0} == direct(rows) and last["gone"] == (0, 0.0, None, None)


def test_table_functions(spark):
    ship_package(spark)
    register_table_functions(spark)
    lines = spark.createDataFrame([(1, "a  b "), (2, ""), (3, None), (4, "   "), (5, "x")], "id int, line string")
    lines.createOrReplaceTempView("some_lines")
    got = spark.sql("select id, w.place, w.word from some_lines join lateral words(line) w").collect()
    assert sorted(map(tuple, got)) == [(1, 0, "a"), (1, 1, ""), (1, 2, "b"), (2, 0, ""), (5, 0, "x")]
    rows = [(1, 3, "b"), (1, 1, "a"), (1, 2, "a"), (2, 9, None), (2, 10, None), (None, 1, "z")]
    spark.createDataFrame(rows, "key bigint, seq bigint, value string").createOrReplaceTempView("some_rows")
    got = spark.sql("select * from runs(table(some_rows) partition by key order by seq)").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, 1, 2, "a", 2), (1, 3, 3, "b", 1), (2, 9, 10, None, 2), (None, 1, 1, "z", 1)], key=repr)
