"""Fingerprints of row sets that do not depend on order and can be merged.

A set of rows is summed up by its count, the sum of its row hashes and their
exclusive or. The three merge by adding and by exclusive or, so one partial
(map-side) aggregate takes the fingerprints of all units of a source at once,
and parts taken apart add up to the whole. A changed, added, removed or
repeated row changes at least one of them but for a chance of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINGERPRINT = ("n_rows", "hash_sum", "hash_xor")
HASH_SUM_TYPE = "decimal(38,0)"


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row. The hash function passes over NULLs, so their places are hashed too."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    return F.xxhash64(*columns, nulls)


def fingerprint(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``keys`` with the fingerprint of each key's rows over ``columns``."""
    hashed = df.select(*keys, row_hash(columns).alias("_hash"))
    return hashed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.col("_hash").cast("decimal(28,0)")), F.lit(0)).cast(HASH_SUM_TYPE).alias("hash_sum"),
        F.coalesce(F.bit_xor("_hash"), F.lit(0)).cast("bigint").alias("hash_xor"))


def merge(fingerprints: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Fingerprints of the unions of the row sets that share ``keys``."""
    return fingerprints.groupBy(*keys).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("hash_sum"), F.lit(0)).cast(HASH_SUM_TYPE).alias("hash_sum"),
        F.coalesce(F.bit_xor("hash_xor"), F.lit(0)).cast("bigint").alias("hash_xor"))
