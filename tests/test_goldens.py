"""Results on small sample files, worked out by hand from their rows."""

from collections import Counter

from pyspark.sql import functions as F

from tidewater import operators as op
from tidewater import streaming as st
from tidewater.functions import epoch_seconds_to_timestamp, json_value, utf16_length
from tidewater.sources import read_lines, read_records
from tidewater.sources.records import AD_CLICK, LOGIN, ORDER, RECEIPT, SENSOR

from tests.samples import CLICKS
from tests.samples import SENSOR as SENSOR_ROWS


def numbered(df):
    """Arrival order of a one-file input."""
    return df.withColumn("seq", F.monotonically_increasing_id())


def sensor(spark, samples):
    return numbered(read_records(spark, f"{samples}/sensor.txt", SENSOR)).withColumn(
        "time", epoch_seconds_to_timestamp("ts")
    )


def tuples(df, order=None):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_line_lengths(spark, samples):
    lines = numbered(read_lines(spark, f"{samples}/sensor.txt"))
    got = tuples(lines.orderBy("seq").select(utf16_length("value")))
    assert [n for (n,) in got] == [len(",".join(map(str, r))) for r in SENSOR_ROWS]


def test_filter(spark, samples):
    assert sorted(r.vc for r in sensor(spark, samples).where("vc > 40").collect()) == [41.5, 44.0, 80.25]


def test_json(spark, samples):
    first = sensor(spark, samples).where("seq = 0").select(json_value("id", "ts", "vc").alias("v")).first().v
    assert first == '{"id":"r1","ts":1600000000,"vc":41.5}'


def test_tumbling(spark, samples):
    """A reading exactly on a window's end belongs to the next window."""
    got = tuples(op.tumbling(sensor(spark, samples), ["id"], "time", "5 seconds", total=F.sum("vc")), ["id", "win_start_ms"])
    assert got == [
        ("r1", 1600000000000, 121.75),
        ("r2", 1600000000000, 39.5),
        ("r2", 1600000005000, 44.0),
        ("r3", 1600000005000, 40.0),
        ("r4", 1599999995000, 7.125),
    ]


def test_running_max_average_and_sum(spark, samples):
    rows = sensor(spark, samples).select("id", "seq", "vc").where("id = 'r1'")
    best = op.max_record_running(rows, ["id"], "vc", "seq").orderBy("seq")
    assert [r.best_vc for r in best.collect()] == [41.5, 80.25]
    seq = op.KeyedSequence(rows, ["id"], ["seq"]).running(total=op.running_sum("vc"), n=op.running_count()).rows()
    assert tuples(seq.select("total", F.col("total") / F.col("n")), ["seq"]) == [(41.5, 41.5), (121.75, 60.875)]


def test_split_jump_dedup_where(spark, samples):
    rows = sensor(spark, samples)
    main, side = op.split_rows(rows, F.col("vc") < 40)
    assert (main.count(), side.count()) == (4, 2)
    alarm = op.jump_alarm(rows, ["id"], ["seq"], "vc", 10.0).collect()
    assert [(r.id, r.previous, r.vc) for r in alarm] == [("r1", 41.5, 80.25)]
    assert op.distinct_first(rows, ["id"], ["seq"]).count() == 4
    assert rows.where("id = 'r2'").count() == 2


def test_retract(spark, samples):
    log = op.retract_count(sensor(spark, samples), ["id"], ["seq"])
    assert log.count() == 8
    assert log.where("not is_add").count() == 2


def test_ad_clicks(spark, samples):
    clicks = numbered(read_records(spark, f"{samples}/clicks.csv", AD_CLICK))
    counts = {(r.province, r.adId): r["count"] for r in clicks.groupBy("province", "adId").count().collect()}
    assert counts == Counter((r[2], r[1]) for r in CLICKS)
    running = op.KeyedSequence(clicks, ["province", "adId"], ["seq"]).running(n=op.running_count()).rows()
    assert sorted(r.n for r in running.where("province = 'north' and adId = 11").collect()) == list(range(1, counts["north", 11] + 1))


def orders_and_receipts(spark, samples):
    orders = read_records(spark, f"{samples}/orders.csv", ORDER)
    paid = orders.where("txId <> ''").withColumn("paid_at", epoch_seconds_to_timestamp("eventTime")).drop("eventTime")
    receipts = read_records(spark, f"{samples}/receipts.csv", RECEIPT)
    return paid, receipts.withColumn("received_at", epoch_seconds_to_timestamp("eventTime")).drop("eventTime")


def test_reconcile(spark, samples):
    paid, receipts = orders_and_receipts(spark, samples)
    assert op.reconcile(paid, receipts, "txId").count() == 4
    left, right = op.unmatched(paid, receipts, "txId")
    assert [r.txId for r in left.collect()] == ["e"]
    assert [r.txId for r in right.collect()] == ["z"]


def test_interval_join(spark, samples):
    """Both bounds count; 11 seconds are too many."""
    paid, receipts = orders_and_receipts(spark, samples)
    pairs = op.interval_join(paid, receipts, "txId", "paid_at", "received_at", -10_000, 10_000)
    assert sorted(r.orderId for r in pairs.collect()) == [1, 2, 4]


FAILURES = [("u", 500, 501), ("u", 501, 502)]


def test_login_fail(spark, samples):
    logins = numbered(read_records(spark, f"{samples}/logins.csv", LOGIN)).withColumn(
        "time", epoch_seconds_to_timestamp("ts")
    )
    found = op.match_times(logins, ["id"], ["time", "seq"], "time", F.col("state") == "fail", 4, 2000)
    got = tuples(found.select("id", F.unix_seconds("first_ts"), F.unix_seconds("last_ts")), ["first_ts", "last_ts"])
    assert got == FAILURES


def test_login_fail_on_a_stream(spark, samples, tmp_path):
    """The row that is older by a second comes later in the file and still finds its place."""
    from tidewater.session import ship_package
    from tidewater.streaming import processors as p
    from tidewater.streaming import windows as sw

    ship_package(spark)
    rows = numbered(read_records(spark, f"{samples}/logins.csv", LOGIN)).selectExpr(
        "id", "seq", "timestamp_seconds(ts) as ts", "state = 'fail' as fail"
    )
    folder = str(tmp_path / "in")
    flush = spark.sql("select 'end' id, 99999L seq, timestamp'2030-01-01' ts, false fail")
    rows.coalesce(1).write.parquet(folder)
    flush.coalesce(1).write.mode("append").parquet(folder)
    s = sw.event_time(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder), "ts", "5 seconds")
    matches = st.apply_stateful(s, ["id"], p.MatchTimes("fail", 4, 2000), time="eventTime")
    out = str(tmp_path / "out")
    st.drain(matches.writeStream.format("parquet").option("path", out), str(tmp_path / "cp"), timeout=120)
    got = sorted((r.id, r.first_ms // 1000, r.last_ms // 1000) for r in spark.read.parquet(out).collect())
    assert got == FAILURES
