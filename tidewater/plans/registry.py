"""Named queries: a plan over the tables, and the same question in SQL where SQL can ask it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidewater.session import ship_package
from tidewater.sources import Tables

Plan = Callable[[Tables], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    plan: Plan
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return self.plan(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under its function name."""

    def register(plan: Plan) -> Plan:
        if plan.__name__ in QUERIES:
            raise ValueError(f"query {plan.__name__} registered twice")
        QUERIES[plan.__name__] = Query(plan.__name__, plan, sql)
        return plan

    return register
