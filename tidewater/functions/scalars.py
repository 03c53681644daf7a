"""Column expressions. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_words(line: Column | str, separator: str = " ") -> Column:
    """Tokens of a line: leading and inner empties kept, trailing empties dropped.

    An empty line is one empty token, a line of separators only has no token, NULL stays NULL.
    ``separator`` is one literal character.
    """
    line = _col(line)
    body = F.rtrim(line) if separator == " " else F.rtrim(line, F.lit(separator))
    nothing = F.array().cast("array<string>")
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(body == "", nothing)
        .otherwise(F.split(body, "\\Q" + separator + "\\E"))
    )


def first_token(line: Column | str, separator: str = " ") -> Column:
    """The token before the first separator, NULL where the line has no token."""
    return F.get(split_words(line, separator), F.lit(0))


def utf16_length(text: Column | str) -> Column:
    """Length in UTF-16 units, so a character outside the basic plane counts twice."""
    return (F.octet_length(F.encode(_col(text), "UTF-16BE")) / 2).cast("bigint")


def epoch_seconds_to_timestamp(seconds: Column | str) -> Column:
    return F.timestamp_seconds(_col(seconds))


def json_value(*columns: str) -> Column:
    """One JSON object per row, fields in the order given."""
    return F.to_json(F.struct(*columns))


def exact_sum(value: Column | str, scale: int = 2) -> Column:
    """Sum of a double column that holds ``scale`` decimals, independent of row order.

    Doubles are added as scaled whole numbers: the result does not depend on how rows were partitioned, and the
    buffer is a long that whole-stage codegen keeps on the fast path (a wide decimal would not).
    """
    return exact_value(F.sum(exact_units(value, scale)), scale)


def exact_units(value: Column | str, scale: int = 2) -> Column:
    """The value in whole units of its last decimal; a value with more decimals is an error, not rounded away."""
    scaled = _col(value) * F.lit(10**scale)
    whole = F.round(scaled)
    fits = F.abs(scaled - whole) <= F.abs(scaled) * F.lit(1e-9) + F.lit(1e-6)
    problem = F.concat(F.lit(f"more than {scale} decimals: "), _col(value).cast("string"))
    return F.when(fits | scaled.isNull(), whole.cast("bigint")).otherwise(F.raise_error(problem).cast("bigint"))


def exact_value(units: Column, scale: int = 2) -> Column:
    return units / F.lit(float(10**scale))
