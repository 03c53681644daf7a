"""Every registered query against its SQL on the small tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from tidewater.plans import QUERIES

from tests.conftest import SF

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def table(frame):
    columns = sorted(frame.columns)
    text = frame[columns].astype(str).replace({"<NA>": "nan", "None": "nan"})
    return columns, sorted(map(tuple, text.itertuples(index=False)))


@pytest.mark.parametrize("name", list(entry_module.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    got = entry_module.queries()[name](spark, SF).toPandas()
    assert table(got) == table(duck.sql(entry_module.oracle_sql()[name]).df())


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_module.oracle_sql())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
