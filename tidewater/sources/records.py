"""Delimited text lines and the record types read from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import split_words
from tidewater.functions.layout import layout


# Record layouts; fixed values.
SENSOR = layout("id string, ts bigint, vc double")
LOGIN = layout("id string, ip string, state string, ts bigint")
AD_CLICK = layout("userId bigint, adId bigint, province string, city string, timestamp bigint")
ORDER = layout("orderId bigint, eventType string, txId string, eventTime bigint")
RECEIPT = layout("txId string, payChannel string, eventTime bigint")


def read_lines(spark: SparkSession, path: str, stream: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """One row ``value`` per text line; with ``stream`` the folder is followed for new files."""
    if not stream:
        return spark.read.text(path)
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def parse_delimited(df: DataFrame, schema: T.StructType, line: str = "value", separator: str = ",") -> DataFrame:
    """Replace the line column by typed fields; other columns stay in front.

    A missing field or a bad number fails the job, fields beyond the schema are ignored, and an empty text field is
    ``''``. Works on streams.
    """
    fields = split_words(line, separator)
    columns = []
    for place, field in enumerate(schema):
        text = F.get(fields, F.lit(place))
        value = text if isinstance(field.dataType, T.StringType) else text.try_cast(field.dataType)
        complaint = F.concat(F.lit(f"field '{field.name}' missing or malformed in line: "), F.col(line))
        columns.append(
            F.when(value.isNull(), F.raise_error(complaint).cast(field.dataType)).otherwise(value).alias(field.name)
        )
    kept = [c for c in df.columns if c != line]
    return df.where(F.col(line).isNotNull()).select(*kept, *columns)


def read_records(
    spark: SparkSession, path: str, schema: T.StructType, stream: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """Typed records from comma separated lines without header."""
    return parse_delimited(read_lines(spark, path, stream, files_per_batch), schema)
