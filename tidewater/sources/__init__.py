from tidewater.sources.growing import GrowingFolder
from tidewater.sources.lines import SensorFolder
from tidewater.sources.records import parse_delimited, read_lines, read_records
from tidewater.sources.tables import Tables, load_table, sql_over, use_catalog

__all__ = [
    "GrowingFolder",
    "SensorFolder",
    "Tables",
    "load_table",
    "parse_delimited",
    "read_lines",
    "read_records",
    "sql_over",
    "use_catalog",
]
