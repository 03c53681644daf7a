"""Exactly once into targets that can only append: rows are staged by the tasks and published by the driver, batch by batch.

A target stages the rows of one task under a receipt that nobody else uses, so a task that is repeated, or runs twice at a time, leaves
rows that are never published. When all tasks of a micro-batch are done, the driver publishes their receipts together with the number of
the batch, in one transaction; a batch whose number the target has seen already is discarded instead. So a batch that was stopped
half-way, or was published but not yet noted by Spark, leaves every row once when it is repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import islice
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter


class Target(Protocol):
    """Sent to the executors; ``stage`` runs in tasks, the others on the driver."""

    def stage(self, rows: Iterator[tuple]) -> Any:
        """Keep the rows aside and return a receipt for them."""

    def publish(self, receipts: list[Any], batch_id: int) -> None:
        """Make the rows of the receipts visible, all or none, unless the batch has been published before."""

    def discard(self, receipts: list[Any]) -> None:
        """Forget staged rows."""


@dataclass
class Staged(WriterCommitMessage):
    receipt: Any


class _Writer(DataSourceStreamWriter):
    def __init__(self, target: Target):
        self.target = target

    def write(self, iterator: Iterator) -> Staged:
        return Staged(self.target.stage(tuple(row) for row in iterator))

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        self.target.publish([m.receipt for m in messages if m is not None], batchId)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        self.target.discard([m.receipt for m in messages if m is not None])


def register_sink(spark: SparkSession, name: str, target: Target) -> None:
    """Make ``target`` a stream sink: ``df.writeStream.format(name)``, append mode, with a checkpoint location."""

    class Sink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
            return _Writer(target)

    spark.dataSource.register(Sink)


def append_once(df: DataFrame, name: str, target: Target) -> DataStreamWriter:
    """A stream writer that appends every row once; start it with a checkpoint location that stays with the target."""
    register_sink(df.sparkSession, name, target)
    return df.writeStream.format(name).outputMode("append")


class TableTarget:
    """A table of any DB-API database. ``connect`` runs on executors and driver; ``stream`` names the query in the ledger.

    Staged rows are in ``<table>_staged``, published batches in ``<table>_batches``; ``create`` makes both. Staged rows of tasks that
    were repeated have no use; ``sweep`` removes all staged rows while no query writes.
    """

    def __init__(self, connect: Callable[[], Any], table: str, columns: list[str], stream: str, mark: str = "?", block: int = 500):
        self.connect, self.table, self.columns, self.stream, self.mark, self.block = connect, table, list(columns), stream, mark, block

    def _run(self, *steps: tuple[str, Iterable[tuple] | None]) -> None:
        connection = self.connect()
        try:
            cursor = connection.cursor()
            for statement, rows in steps:
                if rows is None:
                    cursor.execute(statement)
                else:
                    rows = iter(rows)
                    while chunk := list(islice(rows, self.block)):
                        cursor.executemany(statement, chunk)
            connection.commit()
        finally:
            connection.close()  # without commit: rolls back

    def create(self) -> None:
        names = ", ".join(self.columns)
        self._run(
            (f"create table if not exists {self.table}_staged as select cast('' as varchar(32)) as receipt, {names} from {self.table} where 1 = 0", None),
            (f"create table if not exists {self.table}_batches (stream varchar(200), batch_id bigint, primary key (stream, batch_id))", None),
        )

    def stage(self, rows: Iterator[tuple]) -> str:
        receipt = uuid.uuid4().hex
        marks = ", ".join([self.mark] * (len(self.columns) + 1))
        insert = f"insert into {self.table}_staged (receipt, {', '.join(self.columns)}) values ({marks})"
        self._run((insert, ((receipt, *row) for row in rows)))
        return receipt

    def publish(self, receipts: list[str], batch_id: int) -> None:
        connection = self.connect()
        try:
            cursor = connection.cursor()
            known = f"select count(*) from {self.table}_batches where stream = {self.mark} and batch_id = {self.mark}"
            cursor.execute(known, (self.stream, batch_id))
            fresh = cursor.fetchone()[0] == 0
            names = ", ".join(self.columns)
            if fresh:
                # The key of the ledger makes a second writer of the same batch fail instead of doubling it.
                cursor.execute(f"insert into {self.table}_batches (stream, batch_id) values ({self.mark}, {self.mark})", (self.stream, batch_id))
            for receipt in receipts:
                if fresh:
                    move = f"insert into {self.table} ({names}) select {names} from {self.table}_staged where receipt = {self.mark}"
                    cursor.execute(move, (receipt,))
                cursor.execute(f"delete from {self.table}_staged where receipt = {self.mark}", (receipt,))
            connection.commit()
        finally:
            connection.close()

    def discard(self, receipts: list[str]) -> None:
        self._run((f"delete from {self.table}_staged where receipt = {self.mark}", [(r,) for r in receipts]))

    def sweep(self) -> None:
        self._run((f"delete from {self.table}_staged", None))
