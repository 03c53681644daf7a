"""Parquet tables and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table with its zone-less time stamps read as UTC instants.

    The type is given to the scan instead of casting afterwards: the values do not depend on the session time zone,
    watermarks accept the column, and filters on it still reach the files.
    """
    path = f"{folder.rstrip('/')}/{name}.parquet"
    table = spark.read.parquet(path)
    zoned = T.StructType([_zoned(field) for field in table.schema])
    return table if zoned == table.schema else spark.read.schema(zoned).parquet(path)


def _zoned(field: T.StructField) -> T.StructField:
    if isinstance(field.dataType, T.TimestampNTZType):
        return T.StructField(field.name, T.TimestampType(), field.nullable)
    return field


class Tables:
    """The tables of one folder as attributes: ``Tables(spark, folder).events``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return load_table(self.spark, self.folder, name)


def use_catalog(spark: SparkSession, catalog: str | None = None, database: str | None = None) -> None:
    """Make a registered catalog and database current for later SQL."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    if database:
        spark.catalog.setCurrentDatabase(database)


def sql_over(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """Run SQL over DataFrames under the given names."""
    return spark.sql(text, **views)
