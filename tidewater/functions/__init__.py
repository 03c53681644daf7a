from tidewater.functions.scalars import (
    epoch_seconds_to_timestamp,
    exact_sum,
    first_token,
    json_value,
    split_words,
    utf16_length,
)

__all__ = [
    "epoch_seconds_to_timestamp",
    "exact_sum",
    "first_token",
    "json_value",
    "split_words",
    "utf16_length",
]
