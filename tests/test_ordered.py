"""The chunked plans must agree with plain Python over the whole sequence."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidewater.operators.ordered import (
    CHUNK,
    KeyedSequence,
    hot_keys,
    running_count,
    running_max,
    running_min,
    running_sum,
)


def sample(spark, n=300, seed=1):
    rnd = random.Random(seed)
    seqs = rnd.sample(range(-50, 5000), n)
    # Key "a" holds most rows, NULL is a key too; time stamps repeat heavily.
    rows = [
        (rnd.choice(["a", "a", "a", "b", None]), s, rnd.randrange(20), float(rnd.randrange(30)))
        for s in seqs
    ]
    return rows, spark.createDataFrame(rows, "k string, seq bigint, ts bigint, v double").repartition(3).withColumn(
        "ts", F.timestamp_seconds("ts")
    )


def by_key(rows, order):
    groups = defaultdict(list)
    for row in sorted(rows, key=order):
        groups[row[0]].append(row)
    return groups


@pytest.fixture(params=["plain", "arithmetic", "ranged"])
def mode(request, settings):
    if request.param != "plain":
        settings(hotRows=60, chunkBits=6, chunkRows=11)
    order = ["ts", "seq"] if request.param == "ranged" else ["seq"]
    python_order = (lambda r: (r[2], r[1])) if request.param == "ranged" else (lambda r: r[1])
    return request.param, order, python_order


def test_hot_keys(spark, settings):
    rows, df = sample(spark)
    assert hot_keys(df, ["k"]) is None
    settings(hotRows=100)
    assert [r.k for r in hot_keys(df, ["k"]).collect()] == ["a"]


def test_hot_keys_from_a_share_of_the_rows(spark, settings):
    df = spark.range(200_000).selectExpr("if(id % 3 = 0, -1L, id) as k", "id as seq")
    settings(hotRows=20_000)
    (hot,) = hot_keys(df, ["k"]).collect()
    assert hot.k == -1 and 55_000 < hot["_rows"] < 80_000
    numbered = KeyedSequence(df, ["k"], ["seq"])
    assert numbered.split
    got = numbered.running(n=running_count()).rows().groupBy("k").agg(F.max("n").alias("n")).where("n > 1").collect()
    assert [tuple(r) for r in got] == [(-1, 66_667)]


def test_running(spark, mode):
    name, order, python_order = mode
    rows, df = sample(spark)
    sequence = KeyedSequence(df, ["k"], order)
    assert sequence.split == (name != "plain")
    if sequence.split:
        assert sequence.df.where("k = 'a'").select(CHUNK).distinct().count() > 5
    got = sequence.running(
        total=running_sum("v"), n=running_count(), top=running_max("v", inclusive=False), low=running_min("v")
    ).rows()
    assert got.columns == ["k", "seq", "ts", "v", "total", "n", "top", "low"]
    got = {(r.k, r.seq): (r.total, r.n, r.top, r.low) for r in got.collect()}
    want = {}
    for key, group in by_key(rows, python_order).items():
        values = [r[3] for r in group]
        for i, r in enumerate(group):
            before = values[:i]
            want[key, r[1]] = (sum(values[: i + 1]), i + 1, max(before) if before else None, min(values[: i + 1]))
    assert got == want


@pytest.mark.parametrize("back", [1, 4])
def test_look_back(spark, mode, back):
    _, order, python_order = mode
    rows, df = sample(spark)
    got = (
        KeyedSequence(df, ["k"], order)
        .with_window(back, lambda w: {"prev": F.lag("v", back).over(w), "near": F.sum("v").over(w.rowsBetween(-back, 0))})
        .rows()
    )
    got = {(r.k, r.seq): (r.prev, r.near) for r in got.collect()}
    want = {}
    for key, group in by_key(rows, python_order).items():
        values = [r[3] for r in group]
        for i, r in enumerate(group):
            want[key, r[1]] = (values[i - back] if i >= back else None, sum(values[max(0, i - back) : i + 1]))
    assert got == want


def test_look_back_longer_than_a_chunk(spark, settings):
    settings(hotRows=1, chunkBits=1)
    rows, df = sample(spark)
    got = KeyedSequence(df, ["k"], ["seq"]).with_window(5, lambda w: {"prev": F.lag("seq", 5).over(w)}).rows()
    want = {}
    for key, group in by_key(rows, lambda r: r[1]).items():
        for i, r in enumerate(group):
            want[key, r[1]] = group[i - 5][1] if i >= 5 else None
    assert {(r.k, r.seq): r.prev for r in got.collect()} == want


def test_running_top(spark, mode):
    name, order, python_order = mode
    if name == "ranged":
        pytest.skip("top lists break ties by one arrival number")
    rows, df = sample(spark)
    got = {
        (r.k, r.seq): [(e.value, -e.neg_seq) for e in r.best]
        for r in KeyedSequence(df, ["k"], order).running_top(3, "v", "seq", "best").rows().collect()
    }
    want = {}
    for key, group in by_key(rows, python_order).items():
        for i, r in enumerate(group):
            seen = sorted(((g[3], g[1]) for g in group[: i + 1]), key=lambda p: (-p[0], p[1]))
            want[key, r[1]] = seen[:3]
    assert got == want


@pytest.mark.parametrize("bits", [1, 3, 16])
def test_global_sequence(spark, settings, bits):
    settings(chunkBits=bits)
    rows, df = sample(spark)
    got = KeyedSequence(df, [], ["seq"]).running(n=running_count(), top=running_max("v", inclusive=False)).rows()
    got = {r.seq: (r.n, r.top) for r in got.collect()}
    values = sorted((r[1], r[3]) for r in rows)
    assert got == {s: (i + 1, max((v for _, v in values[:i]), default=None)) for i, (s, _) in enumerate(values)}


def test_empty(spark, split_everything):
    _, df = sample(spark)
    empty = df.limit(0)
    for keys, order in ((["k"], ["seq"]), ([], ["seq"]), ([], ["ts", "seq"])):
        assert KeyedSequence(empty, keys, order).running(n=running_count()).rows().count() == 0


def test_every_hot_key_is_split(spark, settings):
    """No limit on the number of hot keys."""
    settings(hotRows=2)
    df = spark.range(60_000).selectExpr("id % 12000 as k", "id as seq")
    sequence = KeyedSequence(df, ["k"], ["seq"])
    assert sequence.df.where(f"{CHUNK} is null").count() == 0
    assert hot_keys(df, ["k"]).count() == 12_000


@pytest.mark.parametrize("order", ["hashed", "sparse"])
def test_levels_keep_window_partitions_short(spark, settings, order):
    """Digests of ids that are spread over all 62 bits, and of instants far apart, are handed on in levels."""
    settings(chunkBits=21)
    value = "shiftright(xxhash64(id), 2)" if order == "hashed" else "id * 200000"
    df = spark.range(3000).selectExpr(f"{value} as seq", "cast(id % 97 as double) as v")
    sequence = KeyedSequence(df, [], ["seq"])
    assert sequence._levels >= 2 and (2**sequence._bits) ** (sequence._levels + 1) >= 2**63
    done = sequence.running(total=running_sum("v"), n=running_count()).with_window(
        3, lambda w: {"third": F.lag("v", 3).over(w), "some": F.sum("v").over(w.rowsBetween(-2, 0))}
    )
    got = sorted(map(tuple, done.rows().select("seq", "v", "total", "n", "third", "some").collect()))
    total, values = 0.0, [r[1] for r in got]
    for k, (_, v, t, n, third, some) in enumerate(got):
        total += v
        assert (t, n, third, some) == (total, k + 1, values[k - 3] if k > 2 else None, sum(values[max(0, k - 2) : k + 1]))


def test_rows_and_best_are_handed_on_through_levels(spark, settings):
    settings(chunkBits=2)
    rnd = random.Random(5)
    seqs = rnd.sample(range(400), 150)
    df = spark.createDataFrame([(s, float(rnd.randrange(50))) for s in seqs], "seq bigint, v double")
    rows = sorted(map(tuple, df.collect()))
    done = KeyedSequence(df, [], ["seq"]).with_window(9, lambda w: {"ninth": F.lag("v", 9).over(w)}).rows()
    got = {r.seq: r.ninth for r in done.collect()}
    assert got == {s: rows[k - 9][1] if k > 8 else None for k, (s, _) in enumerate(rows)}
    best = KeyedSequence(df, [], ["seq"]).running_top(3, "v", "seq", "top").rows()
    for r in best.collect():
        want = sorted(((v, -s) for s, v in rows if s <= r.seq), reverse=True)[:3]
        assert [(e.value, e.neg_seq) for e in r.top] == want
