from tidewater.sinks.two_step import TableTarget, append_once, register_sink
from tidewater.sinks.upsert import (
    ClientWriter,
    DatabaseWriter,
    EachRow,
    dedup_latest,
    keyed_json,
    send,
    upsert_statement,
    upsert_stream,
)

__all__ = [
    "ClientWriter",
    "DatabaseWriter",
    "EachRow",
    "TableTarget",
    "append_once",
    "dedup_latest",
    "keyed_json",
    "register_sink",
    "send",
    "upsert_statement",
    "upsert_stream",
]
