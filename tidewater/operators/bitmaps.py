"""Distinct counts that merge: bitmaps of dense numbers, kept by bucket, in two levels.

Rows are read once, into one bitmap for each pane and bucket of 32 768 numbers. Larger windows, other groupings and totals come
from the bitmaps alone: a union per bucket, then a sum of counts over buckets. All results are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.ordered import KeyedSequence, running_count
from tidewater.operators.windows import floor_to, window_starts


def dense_ids(df: DataFrame, id: str, out: str) -> DataFrame:
    """Add ``out``: the distinct values of ``id`` numbered from 1, NULL for NULL.

    Bitmaps of sparse or hashed ids would hold one bit a bucket; numbered ids fill their buckets. The numbers hold for this table only.
    """
    names = df.select(F.col(id).alias("_id")).where(F.col("_id").isNotNull()).distinct()
    numbered = KeyedSequence(names, [], ["_id"]).running(**{out: running_count()}).rows()
    return df.drop(out).join(numbered, F.col(id) == F.col("_id"), "left").drop("_id")


def pane_bitmaps(df: DataFrame, keys: list[str], ts_ms: str, number: str, pane_ms: int) -> DataFrame:
    """``keys, pane_start_ms, bucket, bits``: which numbers occur in every pane. Rows without a number or time are left out."""
    rows = df.where(F.col(number).isNotNull() & F.col(ts_ms).isNotNull())
    return rows.groupBy(
        *keys, floor_to(F.col(ts_ms), pane_ms).alias("pane_start_ms"), F.bitmap_bucket_number(number).alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, bucket, bits`` of coarser groups, for example without a key or with a window start in place of the pane."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def roll_up(bitmaps: DataFrame, keys: list[str], size_ms: int, slide_ms: int | None = None) -> DataFrame:
    """``keys, win_start_ms, bucket, bits`` of tumbling or sliding windows; size and slide are multiples of the pane."""
    slide_ms = slide_ms or size_ms
    starts = F.explode(window_starts(F.col("pane_start_ms"), size_ms, slide_ms)).alias("win_start_ms")
    return merge_bitmaps(bitmaps.select(*keys, starts, "bucket", "bits"), [*keys, "win_start_ms"])


def distinct_from(bitmaps: DataFrame, keys: list[str], out: str = "uv") -> DataFrame:
    """``keys, out``: the distinct numbers of every group whose bitmaps have been merged."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(out))
