"""Functions that give any number of rows, for use in SQL: a table argument is read partition by partition, in order."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf


class Words:
    """``words('a b')``: the tokens of a line with their places; trailing empty tokens are dropped, as by ``split_words``."""

    def eval(self, line: str | None) -> Iterator[tuple]:
        if line == "":
            yield 0, ""
        elif line is not None:
            tokens = line.split(" ")
            while tokens and tokens[-1] == "":
                tokens.pop()
            yield from enumerate(tokens)


class Runs:
    """``runs(table(t) partition by key order by seq)``: stretches of equal neighbouring values.

    The table's columns are key, seq and value, by these names; a result has the key, first and last seq, value and rows of a stretch. Only
    the open stretch is kept, so a partition may be of any size; it is read by one task.
    """

    def __init__(self):
        self.open = None

    def eval(self, row: Row) -> Iterator[tuple]:
        if self.open is not None and self.open[3] == row["value"]:
            self.open[2] = row["seq"]
            self.open[4] += 1
            return
        if self.open is not None:
            yield tuple(self.open)
        self.open = [row["key"], row["seq"], row["seq"], row["value"], 1]

    def terminate(self) -> Iterator[tuple]:
        if self.open is not None:
            yield tuple(self.open)


def register_table_functions(spark: SparkSession) -> None:
    """Make ``words`` and ``runs`` (for bigint keys and string values) known to SQL."""
    spark.udtf.register("words", udtf(Words, returnType="place int, word string"))
    spark.udtf.register("runs", udtf(Runs, returnType="key bigint, first_seq bigint, last_seq bigint, value string, n bigint"))
