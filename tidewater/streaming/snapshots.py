"""Keyed state as a table: look into a checkpoint, and start another query from what is found there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_of(spark: SparkSession, checkpoint: str, variable: str = "held", batch: int | None = None, operator: int = 0) -> DataFrame:
    """The value state ``variable`` after micro-batch ``batch`` (None: the last one that was committed), a row per key.

    The columns are the grouping columns and the fields of the state; keys whose state was cleared are absent. The query may be running.
    """
    reader = spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator).option("stateVarName", variable)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load().select("key.*", "value.*")


def state_changes(spark: SparkSession, checkpoint: str, first: int, last: int | None = None, variable: str = "held", operator: int = 0) -> DataFrame:
    """Every change of ``variable`` in micro-batches ``first`` to ``last``: ``batch_id``, ``change_type`` (update, delete), key and state.

    It is read from the change log of the state store, which is there where the query ran with
    ``spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled``.
    """
    reader = spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator).option("stateVarName", variable)
    reader = reader.option("readChangeFeed", "true").option("changeStartBatchId", first)
    if last is not None:
        reader = reader.option("changeEndBatchId", last)
    return reader.load().select("batch_id", "change_type", "key.*", "value.*")


def partition_sizes(spark: SparkSession, checkpoint: str, variable: str = "held", operator: int = 0) -> DataFrame:
    """``partition_id`` and ``keys`` of each part of the state: shows whether another number of partitions is due."""
    reader = spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator).option("stateVarName", variable)
    return reader.load().groupBy("partition_id").agg(F.count("*").alias("keys"))
