"""Row-wise operators and ways to combine or divide row sets."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import split_words


def words(df: DataFrame, line: str = "value", out: str = "word", position: str | None = None) -> DataFrame:
    """One row per token of the line; with ``position`` also the token's place in the line."""
    rest = [c for c in df.columns if c != line]
    if position:
        return df.select(*rest, F.posexplode(split_words(line)).alias(position, out))
    return df.select(*rest, F.explode(split_words(line)).alias(out))


def split_rows(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that do not meet the condition, rows that do). A NULL condition counts as not met."""
    meets = F.coalesce(condition, F.lit(False))
    return df.where(~meets), df.where(meets)


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept."""
    return reduce(DataFrame.unionByName, others, first)


def co_map(left: DataFrame, right: DataFrame, on_left: Column, on_right: Column) -> DataFrame:
    """Two differently typed inputs, one expression each, one output ``(source, value)``."""
    return left.select(F.lit("left").alias("source"), on_left.alias("value")).unionByName(
        right.select(F.lit("right").alias("source"), on_right.alias("value"))
    )


def shuffle_rows(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread rows evenly over partitions, in no particular order; the rows stay the same.

    Without a number of partitions adaptive execution picks it from the measured size. Either way rows are dealt round
    robin, which Spark keeps repeatable when a task is run again; a fresh random number per row would not be.
    """
    return df.repartition(partitions) if partitions else df.hint("rebalance")


def rich_map(
    df: DataFrame,
    schema: str,
    work: Callable[[object, pd.DataFrame], pd.DataFrame],
    opens: Callable[[], object] = lambda: None,
    closes: Callable[[object], None] = lambda resource: None,
) -> DataFrame:
    """``work(resource, batch)`` over Arrow batches with one ``opens``/``closes`` pair per task."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = opens()
        try:
            for batch in batches:
                yield work(resource, batch)
        finally:
            closes(resource)

    return df.mapInPandas(run, schema)
