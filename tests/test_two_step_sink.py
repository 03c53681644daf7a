"""Exactly once into an append table: batches stopped half-way, after staging, or after they were published."""

import sqlite3
from collections import Counter
from pathlib import Path

import pytest

from tidewater.session import ship_package
from tidewater.sinks import TableTarget, append_once
from tidewater.streaming import drain


class Failing(TableTarget):
    """Fails once at the given place; a file remembers that it did."""

    def __init__(self, *args, where, flag, **kwargs):
        super().__init__(*args, **kwargs)
        self.where, self.flag = where, str(flag)

    def _once(self, where):
        if self.where == where and not Path(self.flag).exists():
            Path(self.flag).touch()
            raise RuntimeError(f"stopped {where}")

    def stage(self, rows):
        def broken():
            for n, row in enumerate(rows):
                yield row
                if n == 2:
                    self._once("within a task")

        receipt = super().stage(broken())
        self._once("after staging")
        return receipt

    def publish(self, receipts, batch_id):
        self._once("before publishing")
        super().publish(receipts, batch_id)
        self._once("after publishing")


def database(path):
    return lambda: sqlite3.connect(path, timeout=60)


def prepare(tmp_path, spark):
    ship_package(spark)
    path = str(tmp_path / "target.db")
    with sqlite3.connect(path) as db:
        db.execute("create table readings (id text, vc integer)")
    folder = tmp_path / "in"
    for n in range(3):
        rows = [(f"k{k % 4}", 100 * n + k // 2) for k in range(40)]  # equal rows on purpose: no key could hide a repeat
        spark.createDataFrame(rows, "id string, vc int").repartition(3).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema("id string, vc int").option("maxFilesPerTrigger", 3).parquet(str(folder))
    want = Counter((f"k{k % 4}", 100 * n + k // 2) for n in range(3) for k in range(40))
    return path, stream, want


def stored(path, table="readings"):
    with sqlite3.connect(path) as db:
        return Counter(db.execute(f"select * from {table}").fetchall())


@pytest.mark.parametrize("where", ["within a task", "after staging", "before publishing", "after publishing"])
def test_a_stopped_batch_leaves_each_row_once(spark, tmp_path, where):
    path, stream, want = prepare(tmp_path, spark)
    target = Failing(database(path), "readings", ["id", "vc"], "q1", where=where, flag=tmp_path / "failed", block=2)
    target.create()
    name = "failing_" + where.replace(" ", "_")
    with pytest.raises(Exception):
        drain(append_once(stream, name, target), str(tmp_path / "cp"))
    assert (tmp_path / "failed").exists()
    assert not stored(path) or where == "after publishing"
    drain(append_once(stream, name, target), str(tmp_path / "cp"))
    assert stored(path) == want
    target.sweep()
    assert not stored(path, "readings_staged")
    assert len(stored(path, "readings_batches")) >= 3


def test_two_streams_share_a_table_and_repeated_batches_do_nothing(spark, tmp_path):
    path, stream, want = prepare(tmp_path, spark)
    for name in ("left", "right"):
        target = TableTarget(database(path), "readings", ["id", "vc"], name)
        target.create()
        drain(append_once(stream, f"sink_{name}", target), str(tmp_path / name))
    assert stored(path) == want + want
    receipt = target.stage(iter([("again", 1)]))
    target.publish([receipt], 0)
    assert stored(path) == want + want and not stored(path, "readings_staged")
    target.discard([target.stage(iter([("gone", 1)]))])
    assert not stored(path, "readings_staged")


def test_empty_batches(spark, tmp_path):
    path, stream, _ = prepare(tmp_path, spark)
    target = TableTarget(database(path), "readings", ["id", "vc"], "none")
    target.create()
    drain(append_once(stream.where("vc < 0"), "sink_empty", target), str(tmp_path / "cp"))
    assert not stored(path)
