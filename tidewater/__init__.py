"""Event analytics on Spark: batch operators, their streaming twins, sources and sinks."""

from tidewater.session import build_session

__all__ = ["build_session"]
