"""State of a stopped query seeds another one, with another number of partitions, and the totals go on exactly."""

import pytest
from pyspark.sql import functions as F

from tidewater.session import ship_package
from tidewater.sources import load_table
from tidewater.streaming import apply_stateful, drain, partition_sizes, state_changes, state_of
from tidewater.streaming import processors as p

from tests.conftest import SF

SPLIT = 400
CHANGES = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


@pytest.fixture(scope="module")
def events(spark):
    ship_package(spark)
    rows = load_table(spark, SF, "events").where("event_id < 700")
    return rows.select("user_id", "value", F.col("event_id").alias("seq")).cache()


def folder(rows, path, files=2):
    rows.repartitionByRange(files, "seq").write.parquet(path)
    return path


def run(spark, events, path, out, checkpoint, seed=None):
    read = spark.readStream.schema(events.schema).parquet(path)
    totals = apply_stateful(read, ["user_id"], p.RunningTotals("value"), seed=seed)
    drain(totals.writeStream.outputMode("append").format("parquet").option("path", out), checkpoint)
    return spark.read.parquet(out)


def collected(frame):
    return sorted((r["user_id"], r["seq"], r["n"], round(r["total"], 6), round(r["average"], 6)) for r in frame.collect())


def expected(events, since=-1):
    out, held = [], {}
    for r in sorted(events.collect(), key=lambda r: r["seq"]):
        n, total = held.get(r["user_id"], (0, 0.0))
        held[r["user_id"]] = n, total = n + 1, total + r["value"]
        if r["seq"] >= since:
            out.append((r["user_id"], r["seq"], n, round(total, 6), round(total / n, 6)))
    return sorted(out), held


def test_a_snapshot_seeds_more_partitions(spark, events, tmp_path):
    early, late = events.where(F.col("seq") < SPLIT), events.where(F.col("seq") >= SPLIT)
    first = run(spark, events, folder(early, str(tmp_path / "in1")), str(tmp_path / "out1"), str(tmp_path / "cp1"))
    assert collected(first) == expected(early)[0]
    held = state_of(spark, str(tmp_path / "cp1"))
    assert set(held.columns) == {"user_id", "n", "total"}
    want = expected(early)[1]
    assert {r["user_id"]: (r["n"], pytest.approx(r["total"])) for r in held.collect()} == want
    before = partition_sizes(spark, str(tmp_path / "cp1")).collect()
    assert sum(r["keys"] for r in before) == len(want)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    spark.conf.set(CHANGES, "true")
    try:
        second = run(spark, events, folder(late, str(tmp_path / "in2")), str(tmp_path / "out2"), str(tmp_path / "cp2"), held)
        assert collected(second) == expected(events, SPLIT)[0]
        # A restart of the seeded query does not read the seed again.
        more = events.select("user_id", "value", (F.col("seq") + 1000).alias("seq"))
        more.write.mode("append").parquet(str(tmp_path / "in2"))
        second = run(spark, events, str(tmp_path / "in2"), str(tmp_path / "out2"), str(tmp_path / "cp2"), held)
        assert collected(second) == expected(events.union(more), SPLIT)[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset(CHANGES)
    changes = state_changes(spark, str(tmp_path / "cp2"), 1).where("change_type = 'update'").select("batch_id", "user_id", "n", "total")
    assert {(r["batch_id"], r["user_id"]): (r["n"], pytest.approx(r["total"])) for r in changes.collect()} == {
        (1, user): value for user, value in expected(events.union(more))[1].items()
    }
    after = partition_sizes(spark, str(tmp_path / "cp2")).collect()
    assert len(after) > len(before) and sum(r["keys"] for r in after) == len(expected(events)[1])
    assert {r["user_id"] for r in state_of(spark, str(tmp_path / "cp2"), batch=0).collect()} == set(expected(events)[1])


def test_a_table_seeds_a_stream(spark, events, tmp_path):
    """History that was never streamed, aggregated by columns; users without late rows keep their state."""
    early, late = events.where(F.col("seq") < SPLIT), events.where(F.col("seq") >= SPLIT)
    seed = early.groupBy("user_id").agg(F.sum("value").alias("total"), F.count("*").alias("n"))
    got = run(spark, events, folder(late, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"), seed)
    assert collected(got) == expected(events, SPLIT)[0]
    assert state_of(spark, str(tmp_path / "cp")).count() == len(expected(events)[1])


def test_only_keyed_state_is_seeded(spark, events):
    with pytest.raises(TypeError):
        apply_stateful(events, ["user_id"], p.DedupFirst.__new__(p.DedupFirst), seed=events)
