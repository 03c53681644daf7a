"""Starting streams."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def start_durable(writer: DataStreamWriter, checkpoint: str, every: str = "5 seconds") -> StreamingQuery:
    """Run until stopped, with progress and state saved every ``every``; a restart continues where it stopped."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def drain(writer: DataStreamWriter, checkpoint: str, timeout: int = 600) -> StreamingQuery:
    """Work off what is there now, then stop. A later call with the same checkpoint continues."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream not finished after {timeout} s")
    if query.exception():
        raise query.exception()
    return query
