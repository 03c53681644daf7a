"""Edge rows for every operator family, and chunked plans against plain ones."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidewater import operators as op
from tidewater.operators import pointers
from tidewater.functions import exact_sum, split_words, utf16_length
from tidewater.operators import late
from tidewater.sources import parse_delimited
from tidewater.sources.records import ORDER, SENSOR


def bag(df):
    return Counter(tuple(sorted(r.asDict().items(), key=lambda i: i[0])) for r in df.collect())


def readings(spark, n=400, seed=3, spread=60, dense=False):
    """(k, seq, ts, v): one dominant key, a NULL key, repeated time stamps, values that often repeat."""
    rnd = random.Random(seed)
    rows = []
    for seq in range(n):
        at = seq // 4 if dense else rnd.randrange(spread * 4)
        rows.append((rnd.choice(["a", "a", "a", "b", None]), seq, at, float(rnd.randrange(12))))
    df = spark.createDataFrame(rows, "k string, seq bigint, at bigint, v double")
    return rows, df.withColumn("ts", F.timestamp_seconds("at")).repartition(3)


OPERATORS = {
    "max_field_running": lambda d: op.max_field_running(d.select("k", "seq", "v", "at"), ["k"], "v", ["seq"]),
    "max_record_running": lambda d: op.max_record_running(d.select("k", "seq", "v"), ["k"], "v", "seq"),
    "jump": lambda d: op.jump_alarm(d.select("k", "seq", "v"), ["k"], ["seq"], "v", 4.0),
    "count_tumbling": lambda d: op.count_tumbling(d, ["k"], "seq", 5, total=F.sum("v"), first=F.min("seq")),
    "count_sliding": lambda d: op.count_sliding(d.select("k", "seq", "v"), ["k"], "seq", 5, 2, total=F.sum("v")),
    "sessions": lambda d: op.sessions(d, ["k"], "ts", 2000, total=F.sum("v"), n=F.count(F.lit(1))),
    "retract": lambda d: op.retract_count(d, ["k"], ["seq"]),
    "match": lambda d: op.match_times(d, ["k"], ["ts", "seq"], "ts", F.col("v") > 5, 3, 9000),
    "match_relaxed": lambda d: op.match_times(d, ["k"], ["ts", "seq"], "ts", F.col("v") > 5, 3, 9000, consecutive=False),
    "match_steps": lambda d: op.match_sequence(d, ["k"], ["ts", "seq"], "ts", [F.col("v") > 5, F.col("v") < 3]),
    "no_drop": lambda d: op.no_drop_alarm(d, ["k"], "ts", "seq", "v", 3000),
    "running_distinct": lambda d: op.running_distinct(d.where("k is not null"), "k", "seq"),
    "ordinal": lambda d: op.ordinal(d.select("k", "seq"), ["seq"]),
    "classify": lambda d: op.classify(
        d.select("seq", (F.col("at") * 1000).alias("ms")), "ms", ["seq"], 5000, 5000, 60_000, 20_000
    ),
    "late_updates": lambda d: op.late_updates(
        d.withColumn("ms", F.col("at") * 1000), ["k"], "ms", ["seq"], 20_000, 60_000, 90_000, F.col("v")
    ),
    "late_counts": lambda d: op.sliding_counts_with_late(
        d.select("k", "seq", (F.col("at") * 1000).alias("ms")), ["k"], "ms", ["seq"], 30_000, 5_000, 60_000, 20_000
    )[0],
}


@pytest.mark.parametrize("name", OPERATORS)
def test_split_plan_equals_plain_plan(spark, settings, name):
    _, df = readings(spark)
    settings(chunkBits=30)
    want = bag(OPERATORS[name](df))
    settings(hotRows=50, chunkBits=4, chunkRows=13)
    assert bag(OPERATORS[name](df)) == want
    assert sum(want.values()) > 0
    settings(hotRows=1, chunkBits=1, chunkRows=5)
    assert bag(OPERATORS[name](df)) == want


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_input(spark, name):
    _, df = readings(spark)
    assert OPERATORS[name](df.limit(0)).count() == 0


def walk(rows, wait):
    """The alarm rule, row by row."""
    alarms = []
    for key in {r[0] for r in rows}:
        baseline, timer = None, None
        for _, _, at, v in sorted((r for r in rows if r[0] == key), key=lambda r: (r[2], r[1])):
            if timer is not None and at >= timer:
                alarms.append((key, timer))
                timer = None
            if baseline is not None and v < baseline:
                baseline, timer = v, None
            elif timer is None:
                baseline, timer = v, at + wait
        if timer is not None:
            alarms.append((key, timer))
    return Counter(alarms)


@pytest.mark.parametrize("seed, dense", [(0, False), (1, True)])
def test_no_drop_alarm(spark, settings, seed, dense):
    rows, df = readings(spark, seed=seed, dense=dense, spread=100)
    want = walk(rows, 5)
    for hot in (10**6, 20):
        settings(hotRows=hot, chunkRows=15)
        got = op.no_drop_alarm(df, ["k"], "ts", "seq", "v", 5000)
        assert Counter((r.k, r.alarm_us // 1_000_000) for r in got.collect()) == want


@pytest.mark.parametrize("shape", ["rising", "falling", "waves"])
def test_no_drop_alarm_of_one_large_key(spark, settings, monkeypatch, shape):
    """One key over many blocks and tree levels; rising values never give a row that settles what comes after."""
    monkeypatch.setattr(pointers, "NODE_BITS", 2)
    monkeypatch.setattr(pointers, "BLOCK_BITS", 3)
    value = {"rising": lambda i: i / 7, "falling": lambda i: -i / 7, "waves": lambda i: i % 37 + (i // 200)}[shape]
    rows = [("a", i, i // 2, float(value(i))) for i in range(700)] + [("b", 0, 3, 1.0)]
    df = spark.createDataFrame(rows, "k string, seq bigint, at bigint, v double").withColumn("ts", F.timestamp_seconds("at"))
    settings(hotRows=100, chunkRows=90, chunkBits=4)
    got = op.no_drop_alarm(df, ["k"], "ts", "seq", "v", 9000)
    assert "Python" not in got._jdf.queryExecution().toString() and "InArrow" not in got._jdf.queryExecution().toString()
    assert Counter((r.k, r.alarm_us // 1_000_000) for r in got.collect()) == walk(rows, 9)


def test_no_drop_alarm_with_a_crowded_instant(spark, settings):
    rnd = random.Random(9)
    rows = [("a", i, 50 if i % 3 else rnd.randrange(200), float(rnd.randrange(9))) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, seq bigint, at bigint, v double").withColumn("ts", F.timestamp_seconds("at"))
    settings(hotRows=20, chunkRows=15)
    got = op.no_drop_alarm(df, ["k"], "ts", "seq", "v", 5000)
    assert Counter((r.k, r.alarm_us // 1_000_000) for r in got.collect()) == walk(rows, 5)


def test_no_drop_alarm_edges(spark):
    rows = [("rise", 0, 0, -3.0), ("rise", 1, 5, -3.0), ("zero", 2, 0, 0.0), ("zero", 3, 4, -1.0), ("zero", 4, 9, -1.0)]
    df = spark.createDataFrame(rows, "k string, seq bigint, at bigint, v double").withColumn("ts", F.timestamp_seconds("at"))
    got = op.no_drop_alarm(df, ["k"], "ts", "seq", "v", 5000)
    # A row at the very moment of expiry comes after the alarm; the drop at 4 stops the first timer of "zero".
    assert Counter((r.k, r.alarm_us // 1_000_000) for r in got.collect()) == Counter(
        [("rise", 5), ("rise", 10), ("zero", 14)]
    )


def test_split_words(spark):
    lines = ["", "   ", "a  b  ", " a", "a b", None, "x\ny z"]
    df = spark.createDataFrame([(s,) for s in lines], "s string")
    got = [r.w for r in df.select(split_words("s").alias("w")).collect()]
    assert got == [[""], [], ["a", "", "b"], ["", "a"], ["a", "b"], None, ["x\ny", "z"]]
    piped = spark.createDataFrame([("a|b||",)], "s string").select(split_words("s", "|").alias("w")).first().w
    assert piped == ["a", "b"]


def test_utf16_length(spark):
    df = spark.createDataFrame([("a\U0001f600",), ("é",)], "s string")
    assert [r.n for r in df.select(utf16_length("s").alias("n")).collect()] == [3, 1]


def test_parse_is_strict(spark):
    def parse(line, schema=SENSOR):
        return parse_delimited(spark.createDataFrame([(line,)], "value string"), schema).collect()

    assert tuple(parse("ws,12,3.5")[0]) == ("ws", 12, 3.5)
    assert tuple(parse("ws,12,3.5,more")[0]) == ("ws", 12, 3.5)
    assert tuple(parse("1,create,,9", ORDER)[0]) == (1, "create", "", 9)
    for bad in ("ws,12", "ws,twelve,3.5", "ws,12,", ""):
        with pytest.raises(Exception, match="missing or malformed"):
            parse(bad)


def test_split_rows_puts_null_on_one_side(spark):
    df = spark.createDataFrame([(39.9,), (40.0,), (None,)], "v double")
    main, side = op.split_rows(df, F.col("v") < 40)
    assert sorted((r.v for r in main.collect()), key=str) == [40.0, None]
    assert [r.v for r in side.collect()] == [39.9]


def test_interval_bounds_are_inclusive(spark):
    left = spark.createDataFrame([("k", 100), (None, 100), ("k", None)], "k string, l bigint")
    right = spark.createDataFrame([("k", t) for t in (89, 90, 100, 110, 111, None)], "k string, r bigint")
    left, right = left.withColumn("lt", F.timestamp_seconds("l")), right.withColumn("rt", F.timestamp_seconds("r"))
    got = op.interval_join(left, right, "k", "lt", "rt", -10_000, 10_000)
    assert sorted(r.r for r in got.collect()) == [90, 100, 110]


def test_interval_join_against_brute_force(spark):
    rnd = random.Random(5)
    left = [(rnd.choice("ab"), i, rnd.randrange(-200, 200)) for i in range(120)]
    right = [(rnd.choice("ab"), i, rnd.randrange(-200, 200)) for i in range(120)]
    ldf = spark.createDataFrame(left, "k string, li bigint, l bigint").withColumn("lt", F.timestamp_seconds("l"))
    rdf = spark.createDataFrame(right, "k string, ri bigint, r bigint").withColumn("rt", F.timestamp_seconds("r"))
    for lower, upper in ((-10, 10), (0, 3), (-7, -2), (5, 5)):
        got = op.interval_join(ldf, rdf, "k", "lt", "rt", lower * 1000, upper * 1000)
        want = Counter((a[1], b[1]) for a in left for b in right if a[0] == b[0] and a[2] + lower <= b[2] <= a[2] + upper)
        assert Counter((r.li, r.ri) for r in got.collect()) == want


def test_reconcile_repeats_and_nulls(spark):
    left = spark.createDataFrame([("x", 1), ("x", 2), (None, 3), ("y", 4)], "k string, l int")
    right = spark.createDataFrame([("x", 1), ("x", 2), (None, 3)], "k string, r int")
    assert op.reconcile(left, right, "k").count() == 4
    only_left, only_right = op.unmatched(left, right, "k")
    assert sorted((r.l for r in only_left.collect())) == [3, 4]
    assert [r.r for r in only_right.collect()] == [3]


def test_window_edges(spark):
    df = spark.createDataFrame([("k", 0, 0), ("k", 1, 5), ("k", 2, 10), (None, 3, 4)], "k string, seq bigint, at bigint")
    df = df.withColumn("ts", F.timestamp_seconds("at")).withColumn("v", F.lit(1.0))
    got = op.tumbling(df, ["k"], "ts", "5 seconds", n=F.count(F.lit(1)))
    assert bag(got) == bag(spark.createDataFrame([("k", 0, 1), ("k", 5000, 1), ("k", 10000, 1), (None, 0, 1)], "k string, win_start_ms bigint, n bigint"))
    # Exactly the gap apart still joins.
    got = op.sessions(df, ["k"], "ts", 5000, n=F.count(F.lit(1)))
    assert {(r.k, r.session_start_ms, r.session_end_ms, r.n) for r in got.collect()} == {("k", 0, 15000, 3), (None, 4000, 9000, 1)}
    native = df.groupBy("k", F.session_window("ts", "5 seconds")).count()
    assert {r["count"] for r in native.collect()} == {3, 1}


def test_sessions_with_a_crowded_instant(spark, settings):
    """One key with most rows at one instant: the copies count, but only once in the ordering."""
    rows = [("a", 7)] * 50 + [("a", t) for t in (1, 3, 12, 40, 41)] + [("b", 7), (None, 7), (None, 8)]
    df = spark.createDataFrame(rows, "k string, at bigint").withColumn("ts", F.timestamp_seconds("at"))
    want = {("a", 1, 4, 2), ("a", 7, 8, 50), ("a", 12, 13, 1), ("a", 40, 42, 2), ("b", 7, 8, 1), (None, 7, 9, 2)}
    for hot in (1000, 20, 1):
        settings(hotRows=hot, chunkBits=3)
        got = op.sessions(df, ["k"], "ts", 2000, n=F.count(F.lit(1)))
        flat = {(r.k, r.session_start_ms // 1000, (r.session_end_ms - 1000) // 1000, r.n) for r in got.collect()}
        assert flat == want
    one = op.sessions(df.drop("k"), [], "ts", 2000, n=F.count(F.lit(1)))
    assert sum(r.n for r in one.collect()) == 58


@pytest.mark.parametrize("size,slide", [(6, 2), (5, 2), (5, 5), (3, 7)])
def test_sliding_against_spark_window(spark, size, slide):
    _, df = readings(spark)
    got = op.sliding(df, ["k"], "ts", size * 1000, slide * 1000, total=("sum", F.col("v")), top=("max", F.col("v")))
    if slide > size:
        want = defaultdict(float)
        for r in df.collect():
            start = int(r.at) // slide * slide
            if r.at < start + size:
                want[r.k, start * 1000] += r.v
        assert {(r.k, r.win_start_ms): r.total for r in got.collect()} == want
        return
    native = df.groupBy("k", F.window("ts", f"{size} seconds", f"{slide} seconds").alias("w")).agg(
        F.sum("v").alias("total"), F.max("v").alias("top")
    )
    assert bag(got) == bag(native.select("k", F.unix_millis("w.start").alias("win_start_ms"), "total", "top"))


def test_first_wins_on_ties(spark):
    rows = [("k", 0, 5.0, "first"), ("k", 1, 5.0, "second"), ("k", 2, None, "null")]
    df = spark.createDataFrame(rows, "k string, seq bigint, v double, name string")
    assert op.max_record(df, ["k"], "v", "seq").first().name == "first"
    assert {r.best_name for r in op.max_record_running(df, ["k"], "v", "seq").collect()} == {"first"}
    assert op.distinct_first(df, ["k", "v"], ["seq"]).where("v = 5").first().name == "first"
    kept = op.max_field(spark.createDataFrame([("k", 0, 1.0, "a"), ("k", 1, 9.0, "b")], df.schema), ["k"], "v", ["seq"])
    assert tuple(kept.first()) == ("k", 0, 9.0, "a")


def replay(rows, size, delay, lateness):
    """Row by row: class per row, in arrival order."""
    peak, out = None, {}
    for seq, ms in rows:
        start = ms // size * size
        wm = None if peak is None else peak - delay - 1
        if wm is None or start + size - 1 > wm:
            out[seq] = late.ON_TIME
        elif start + size - 1 + lateness > wm:
            out[seq] = late.LATE
        else:
            out[seq] = late.ASIDE
        peak = ms if peak is None else max(peak, ms)
    return out


def test_classes_and_updates_against_replay(spark):
    rnd = random.Random(2)
    rows = [(i, max(0, i * 500 - rnd.choice([0, 0, 0, 4000, 9000, 20000]))) for i in range(200)]
    df = spark.createDataFrame(rows, "seq bigint, ms bigint")
    want = replay(rows, 5000, 3000, 2000)
    got = op.classify(df, "ms", ["seq"], 5000, 5000, 3000, 2000)
    assert {r.seq: r.lateness for r in got.collect()} == want
    assert len(set(want.values())) == 3
    # Firings: all on-time rows at once, then one per late row.
    fires, total = defaultdict(list), Counter()
    on_time = Counter(ms // 5000 * 5000 for seq, ms in rows if want[seq] == late.ON_TIME)
    for start, n in on_time.items():
        fires[start].append(n)
        total[start] = n
    for seq, ms in rows:
        if want[seq] == late.LATE:
            start = ms // 5000 * 5000
            total[start] += 1
            fires[start].append(total[start])
    updates = op.late_updates(df, [], "ms", ["seq"], 5000, 3000, 2000, F.lit(1))
    assert Counter((r.win_start_ms, r.fire_no, r.value) for r in updates.collect()) == Counter(
        (start, i, n) for start, ns in fires.items() for i, n in enumerate(ns, 1)
    )


def test_sliding_late_counts_against_replay(spark):
    rnd = random.Random(4)
    rows = [(i, max(0, i * 700 - rnd.choice([0, 0, 3000, 25000, 40000]))) for i in range(200)]
    df = spark.createDataFrame(rows, "seq bigint, ms bigint").withColumn("k", F.lit("k"))
    size, slide, delay, lateness = 30_000, 5_000, 2_000, 2_000
    want, aside, peak = Counter(), set(), None
    for seq, ms in rows:
        wm = None if peak is None else peak - delay - 1
        starts = [s for s in range(ms // slide * slide, ms - size, -slide)]
        open_ = [s for s in starts if wm is None or s + size - 1 + lateness > wm]
        want.update(open_)
        if not open_:
            aside.add(seq)
        peak = ms if peak is None else max(peak, ms)
    counts, late_rows = op.sliding_counts_with_late(df, ["k"], "ms", ["seq"], size, slide, delay, lateness)
    assert {r.win_start_ms: r.cnt for r in counts.collect()} == want
    assert {r.seq for r in late_rows.collect()} == aside and aside


class Spread(op.Aggregator):
    schema = "low double, high double, n bigint"
    columns = ["v"]
    result_schema = "spread double, n bigint"

    def partial(self, groups):
        return groups.agg(low=("v", "min"), high=("v", "max"), n=("v", "size"))

    def merge(self, groups):
        return groups.agg(low=("low", "min"), high=("high", "max"), n=("n", "sum"))

    def result(self, accumulators):
        return accumulators.assign(spread=accumulators.high - accumulators.low)


@pytest.mark.parametrize("held", [1, 50_000])
def test_python_aggregate(spark, held):
    _, df = readings(spark)
    got = op.aggregate_with(df, ["k", "at"], Spread(), held)
    want = df.groupBy("k", "at").agg((F.max("v") - F.min("v")).alias("spread"), F.count(F.lit(1)).alias("n"))
    assert bag(got) == bag(want)


def test_exact_sum_ignores_row_order(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,), (None,)], "v double")
    assert df.agg(exact_sum("v").alias("s")).first().s == 0.6


@pytest.mark.parametrize("partitions", [1, 4, 50])
def test_result_does_not_depend_on_partitions(spark, partitions):
    _, df = readings(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    want = bag(OPERATORS["late_counts"](df))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        assert bag(OPERATORS["late_counts"](df.repartition(partitions))) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
