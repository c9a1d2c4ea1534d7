"""Distinct counts that can be stored and merged, exactly.

A set of whole numbers is kept as bitmaps: bucket ``b`` holds the bits of one
stretch of 32,768 numbers. Sets merge by the bitwise or of equal buckets, so
the distinct numbers of any span of stored groups are counted without reading
their rows again. A bitmap has 4 KiB however many rows its bucket has; one
aggregate, combined in each task, makes them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def number_sets(rows: DataFrame, number: str, keys: Sequence[str]) -> DataFrame:
    """``keys, bucket, bits`` of the distinct ``number``s of each group; NULL is no number."""
    return (rows.filter(F.col(number).isNotNull())
            .select(*keys, F.bitmap_bucket_number(number).alias("bucket"),
                    F.bitmap_bit_position(number).alias("_bit"))
            .groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bits")))


def distinct_numbers(sets: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct numbers of each group of ``keys``, which may be coarser than the stored groups."""
    merged = sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
