import sqlite3
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewater import operators as op
from tidewater.session import ship_package
from tidewater.sinks import (
    ClientWriter,
    DatabaseWriter,
    EachRow,
    dedup_latest,
    keyed_json,
    send,
    upsert_statement,
    upsert_stream,
)
from tidewater.sources import SensorFolder, kafka, load_table, read_records, sql_over, use_catalog
from tidewater.sources.records import SENSOR
from tidewater.streaming import drain

from tests.conftest import SF


def sensors(spark, rows):
    return spark.createDataFrame(rows, "id string, ts bigint, vc double")


def test_load_table_is_free_of_the_session_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    values = set()
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            values.add(load_table(spark, SF, "events").agg(F.min(F.unix_micros("ts"))).first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert len(values) == 1


def test_filters_and_columns_reach_the_scan(spark):
    plan = load_table(spark, SF, "events").where("ts > timestamp'2024-01-15' and user_id = 7").select("event_id", "ts")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in text and "EqualTo(user_id,7)" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp,user_id:bigint>" in text


def test_sensor_folder_batch_and_stream(spark, tmp_path):
    ship_package(spark)
    spark.dataSource.register(SensorFolder)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.txt").write_text("a,1,1.5\nb,2,2.5\n")
    (folder / "2.txt").write_text("a,3,3.5")
    assert spark.read.format("sensor_folder").load(str(folder)).agg(F.sum("vc")).first()[0] == 7.5
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        s = spark.readStream.format("sensor_folder").load(str(folder))
        drain(s.writeStream.format("parquet").option("path", out), cp)
        return sorted(r.ts for r in spark.read.parquet(out).collect())

    assert run() == [1, 2, 3]
    (folder / "3.txt").write_text("c,4,0.0\n")
    assert run() == [1, 2, 3, 4]


def test_catalog_scan(spark):
    spark.sql("create database if not exists streams")
    spark.range(3).createOrReplaceTempView("emp")
    use_catalog(spark, "spark_catalog", "streams")
    try:
        assert spark.catalog.currentDatabase() == "streams"
        assert spark.sql("select * from emp").count() == 3
        assert sql_over(spark, "select max(id) as m from {t}", t=spark.range(5)).first().m == 4
    finally:
        use_catalog(spark, database="default")


def test_kafka_options():
    assert kafka.source_options("h:9092", "test", "hh") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "test",
        "startingOffsets": "latest",
        "kafka.group.id": "hh",
    }
    assert kafka.sink_options("h:9092", "test") == {"kafka.bootstrap.servers": "h:9092", "topic": "test"}


def test_kafka_payload(spark):
    raw = spark.createDataFrame([(bytearray("wärme".encode()),)], "value binary")
    assert kafka.text_values(raw).first().value == "wärme"


def test_dedup_latest(spark):
    rows = sensors(spark, [("a", 1, 1.0), ("a", 3, 3.0), ("a", 2, 2.0), (None, 1, 9.0)])
    got = {(r.id, r.ts, r.vc) for r in dedup_latest(rows, ["id"], ["ts"]).collect()}
    assert got == {("a", 3, 3.0), (None, 1, 9.0)}


def test_statements():
    assert upsert_statement("sensor", ["id", "ts", "vc"], ["id"]) == (
        "insert into sensor (id, ts, vc) values (?, ?, ?) on conflict (id) do update set ts = excluded.ts, vc = excluded.vc"
    )
    assert upsert_statement("sensor", ["id", "ts"], ["id"], "mysql", "%s") == (
        "insert into sensor (id, ts) values (%s, %s) on duplicate key update ts = values(ts)"
    )


def test_database_upsert_from_a_stream(spark, tmp_path):
    """A repeated and a later batch leave one row per key, the latest."""
    ship_package(spark)
    path = str(tmp_path / "db")
    db = sqlite3.connect(path)
    db.execute("create table sensor (id text primary key, ts integer, vc real)")
    db.commit()
    folder = tmp_path / "in"
    folder.mkdir()
    writer = DatabaseWriter(lambda: sqlite3.connect(path, timeout=60), upsert_statement("sensor", ["id", "ts", "vc"], ["id"]))

    def run():
        s = read_records(spark, str(folder), SENSOR, stream=True)
        drain(upsert_stream(s, ["id"], ["ts"], writer), str(tmp_path / "cp"))
        return sorted(db.execute("select * from sensor").fetchall())

    (folder / "1.txt").write_text("a,1,1.0\na,2,2.0\nb,1,1.0\n")
    assert run() == [("a", 2, 2.0), ("b", 1, 1.0)]
    (folder / "2.txt").write_text("b,5,5.0\n")
    assert run() == [("a", 2, 2.0), ("b", 5, 5.0)]


class FolderClient:
    """Stands in for a key-value client: one file per key."""

    def __init__(self, folder):
        self.folder = Path(folder)

    def put(self, key, value):
        (self.folder / key).write_text(value)

    def close(self):
        (self.folder / "closed").write_text("yes")


def put_block(client, rows):
    for r in rows:
        client.put(r.key, r.value)


def put_row(client, row):
    client.put(row.id, str(row.vc))


def test_client_writer(spark, tmp_path):
    ship_package(spark)
    folder = str(tmp_path)
    rows = keyed_json(sensors(spark, [("a", 1, 1.0), ("b", 2, 2.0)]), "id")
    send(rows, ClientWriter(lambda: FolderClient(folder), put_block), block=1)
    assert (tmp_path / "a").read_text() == '{"id":"a","ts":1,"vc":1.0}'
    assert (tmp_path / "b").exists() and (tmp_path / "closed").exists()


def test_row_sink(spark, samples, tmp_path):
    ship_package(spark)
    out = tmp_path / "out"
    out.mkdir()
    folder = str(out)
    s = read_records(spark, f"{samples}/sensor.tx*", SENSOR, stream=True)
    drain(s.writeStream.foreach(EachRow(lambda: FolderClient(folder), put_row)), str(tmp_path / "cp"))
    assert (out / "r3").read_text() == "40.0"
    assert (out / "closed").exists()


def test_rich_map_opens_and_closes(spark, tmp_path):
    log = str(tmp_path / "log")

    def note(text):
        with open(log, "a") as f:
            f.write(text)

    def closes(resource):
        note("c")

    def opens():
        note("o")
        return 10

    df = spark.range(5).repartition(1)
    got = op.rich_map(df, "id bigint", lambda r, b: b + r, opens, closes)
    assert sorted(r.id for r in got.collect()) == [10, 11, 12, 13, 14]
    assert Path(log).read_text() == "oc"


def test_union_comap_shuffle(spark):
    a, b = spark.createDataFrame([(1,), (1,)], "x int"), spark.createDataFrame([(1,), (2,)], "x int")
    assert sorted(r.x for r in op.union_all(a, b, b).collect()) == [1, 1, 1, 1, 2, 2]
    assert sorted(r.x for r in op.shuffle_rows(b, 3).collect()) == [1, 2]
    text = spark.createDataFrame([("abc",)], "s string")
    got = op.co_map(a, text, F.col("x").cast("string"), F.length("s").cast("string"))
    assert sorted(map(tuple, got.collect())) == [("left", "1"), ("left", "1"), ("right", "3")]


def test_checkpoint_folder_must_be_shared(spark, monkeypatch):
    from tidewater import session

    class Cluster:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Fake:
        sparkContext = Cluster()
        conf = spark.conf

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_folder(Fake())
