"""Options and payload handling for Kafka topics; the connector itself comes with the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def source_options(servers: str, topic: str, group: str | None = None, offsets: str = "latest") -> dict[str, str]:
    """Options for ``spark.readStream.format("kafka")``."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": offsets}
    if group:
        options["kafka.group.id"] = group
    return options


def sink_options(servers: str, topic: str) -> dict[str, str]:
    """Options for ``writeStream.format("kafka")``."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def text_values(messages: DataFrame) -> DataFrame:
    """The UTF-8 payload of each message as column ``value``."""
    return messages.select(F.col("value").cast("string").alias("value"))
