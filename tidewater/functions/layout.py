"""Row layouts written as text, also where there is no session (in Python workers)."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "array<boolean>": T.ArrayType(T.BooleanType()),
    "array<double>": T.ArrayType(T.DoubleType()),
    "array<bigint>": T.ArrayType(T.LongType()),
}


def layout(fields: str) -> T.StructType:
    """``layout("id string, ts bigint")``."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])
