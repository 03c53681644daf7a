"""Keyed upsert: the last row per key wins within a batch; across batches the later batch wins, or the later row where
the statement is told which column is newer.

A writer is any object with ``open()``, ``write(rows)`` and ``close()``. It is sent to the executors and used once per
partition, so every partition holds one connection and sends whole blocks of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import islice
from typing import Any, Protocol

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


class Writer(Protocol):
    def open(self) -> None: ...

    def write(self, rows: list[Row]) -> None: ...

    def close(self) -> None: ...


def dedup_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key. One aggregation, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    latest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_latest")
    return df.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in rest]).select(*df.columns)


def send(df: DataFrame, writer: Writer, block: int = 500) -> None:
    """Hand the rows of every partition to a copy of ``writer`` in blocks."""

    def run(rows: Iterable[Row]) -> None:
        rows = iter(rows)
        writer.open()
        try:
            while chunk := list(islice(rows, block)):
                writer.write(chunk)
        finally:
            writer.close()

    df.foreachPartition(run)


def upsert_stream(
    df: DataFrame, keys: list[str], order: list[str], writer: Writer, block: int = 500
) -> DataStreamWriter:
    """A stream writer that upserts every micro-batch; start it with a checkpoint location.

    A batch that Spark repeats is upserted again: harmless for writers that replace by key. Writers that append use
    ``append_once`` instead.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        send(dedup_latest(batch, keys, order), writer, block)

    return df.writeStream.foreachBatch(each_batch)


class DatabaseWriter:
    """Upsert through any Python DB-API connection; ``connect`` runs on the executor."""

    def __init__(self, connect: Callable[[], Any], statement: str):
        self.connect = connect
        self.statement = statement

    def open(self) -> None:
        self.connection = self.connect()

    def write(self, rows: list[Row]) -> None:
        self.connection.executemany(self.statement, [tuple(r) for r in rows])
        self.connection.commit()

    def close(self) -> None:
        self.connection.close()

    def __getstate__(self) -> dict:
        return {"connect": self.connect, "statement": self.statement}


def upsert_statement(
    table: str, columns: list[str], keys: list[str], dialect: str = "standard", mark: str = "?", newer: str | None = None
) -> str:
    """``insert ... on conflict ... do update`` or, for ``dialect="mysql"``, ``... on duplicate key update``.

    ``newer`` names the column by which a stored row may only be replaced by one that is not older.
    """
    changed = [c for c in columns if c not in keys]
    insert = f"insert into {table} ({', '.join(columns)}) values ({', '.join([mark] * len(columns))})"
    if dialect == "mysql":
        new = "values({c})" if newer is None else f"if(values({newer}) >= {newer}, values({{c}}), {{c}})"
        changed.sort(key=lambda c: c == newer)  # assignments run from left to right and must all see the stored value
        return f"{insert} on duplicate key update {', '.join(f'{c} = {new.format(c=c)}' for c in changed)}"
    guard = f" where excluded.{newer} >= {table}.{newer}" if newer else ""
    return f"{insert} on conflict ({', '.join(keys)}) do update set {', '.join(f'{c} = excluded.{c}' for c in changed)}{guard}"


class ClientWriter:
    """Upsert through a client object: ``put(client, rows)`` sends a block.

    Fits hash stores (``hset(name, id, json)``) and document stores (bulk index by id); see ``keyed_json``.
    """

    def __init__(self, connect: Callable[[], Any], put: Callable[[Any, list[Row]], None]):
        self.connect = connect
        self.put = put
        self.client = None

    def open(self) -> None:
        self.client = self.connect()

    def write(self, rows: list[Row]) -> None:
        self.put(self.client, rows)

    def close(self) -> None:
        close = getattr(self.client, "close", None)
        self.client = None
        if close:
            close()


def keyed_json(df: DataFrame, key: str) -> DataFrame:
    """``key`` as text and the whole row as a JSON ``value``: what hash and document stores keep."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


class EachRow:
    """For ``writeStream.foreach``: one connection per partition and epoch, one call per row.

    Rows of a repeated batch are put again; a target for which that matters implements ``two_step.Target``.
    """

    def __init__(self, connect: Callable[[], Any], put: Callable[[Any, Row], None]):
        self.connect = connect
        self.put = put

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.client = self.connect()
        return True

    def process(self, row: Row) -> None:
        self.put(self.client, row)

    def close(self, error: Exception | None) -> None:
        close = getattr(getattr(self, "client", None), "close", None)
        if close:
            close()
