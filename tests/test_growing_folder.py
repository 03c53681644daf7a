"""The growing folder: appended lines, late files, bounded micro-batches and restarts; every line once."""

import os
from collections import Counter

import pytest

from tidewater.session import ship_package
from tidewater.sources import GrowingFolder


class Reader:
    def __init__(self, spark, tmp_path, **options):
        ship_package(spark)
        spark.dataSource.register(GrowingFolder)
        self.spark, self.options = spark, {"log": str(tmp_path / "log"), **options}
        self.folder, self.out, self.cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
        self.folder.mkdir()
        self.batches = []

    def run(self, path=None):
        """A fresh start with the same checkpoint, until nothing is left to read."""
        stream = self.spark.readStream.format("growing_folder").options(**self.options).load(path or str(self.folder))

        def keep(batch, batch_id):
            rows = batch.collect()
            if rows:
                self.batches.append(rows)

        query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", self.cp).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return Counter((r.file, r.value) for rows in self.batches for r in rows)


def lines(name, *texts):
    return Counter((name, t) for t in texts)


def test_appended_and_late_files_are_read_once(spark, tmp_path):
    reader = Reader(spark, tmp_path)
    (reader.folder / "b.txt").write_text("one\ntwo\nopen")
    assert reader.run() == lines("b.txt", "one", "two")
    with (reader.folder / "b.txt").open("a") as file:
        file.write(" end\nthree\r\n")
    late = reader.folder / "a.txt"
    late.write_text("é\n\nlate\n")
    os.utime(late, (1, 1))  # older than anything read
    (reader.folder / "_ignored").write_text("no\n")
    assert reader.run() == lines("b.txt", "one", "two", "open end", "three") + lines("a.txt", "é", "", "late")
    assert reader.run() == lines("b.txt", "one", "two", "open end", "three") + lines("a.txt", "é", "", "late")


def test_a_backlog_comes_in_bounded_batches_across_restarts(spark, tmp_path):
    reader = Reader(spark, tmp_path, bytesPerTrigger="300", splitBytes="64")
    want = Counter()
    for n in range(4):
        texts = [f"{n}-{k}-" + "x" * (k * 7 % 40) for k in range(20)]
        (reader.folder / f"{n}.txt").write_text("".join(t + "\n" for t in texts))
        want += lines(f"{n}.txt", *texts)
    long = "y" * 1000
    (reader.folder / "long.txt").write_text(f"{long}\nshort\n")
    want += lines("long.txt", long, "short")
    assert reader.run(f"file://{reader.folder}") == want
    sizes = [sum(len(r.value) + 1 for r in rows) for rows in reader.batches]
    assert len(sizes) > 5 and sorted(sizes)[-2] <= 300 and max(sizes) <= 1001
    with (reader.folder / "2.txt").open("a") as file:
        file.write("more\n")
    assert reader.run() == want + lines("2.txt", "more")
    places = {(r.file, r.at): r.value for rows in reader.batches for r in rows}
    for (name, at), value in places.items():
        assert (reader.folder / name).read_bytes()[at:].startswith(value.encode())


def test_a_logged_entry_that_was_never_planned_is_not_lost(spark, tmp_path):
    reader = Reader(spark, tmp_path)
    (reader.folder / "a.txt").write_text("first\n")
    reader.run()
    (reader.folder / "a.txt").open("a").write("second\n")
    stopped = GrowingFolder({"path": str(reader.folder), **reader.options}).streamReader(None)
    assert stopped.latestOffset() == {"entry": 2}  # written to the log, and then the driver is gone
    (reader.folder / "a.txt").open("a").write("third\n")
    assert reader.run() == lines("a.txt", "first", "second", "third")


def test_summaries_and_shorter_files(spark, tmp_path):
    folder, log = tmp_path / "in", tmp_path / "log"
    folder.mkdir()
    options = {"path": str(folder), "log": str(log), "bytesPerTrigger": "1"}
    stream = GrowingFolder(options).streamReader(None)
    (folder / "a.txt").write_text("".join(f"{k}\n" for k in range(230)))
    for n in range(1, 231):
        assert stream.latestOffset() == {"entry": n}
    assert stream.latestOffset() == {"entry": 230}
    fresh = GrowingFolder(options).streamReader(None)
    assert fresh.latestOffset() == {"entry": 230} and fresh.reached == stream.reached
    got = [v for part in fresh.partitions({"entry": 0}, {"entry": 230}) for batch in fresh.read(part) for v in batch.column(0).to_pylist()]
    assert got == [str(k) for k in range(230)]
    (folder / "a.txt").write_text("0\n")
    with pytest.raises(ValueError, match="shorter"):
        fresh.latestOffset()
