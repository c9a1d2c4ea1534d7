"""Fact-to-dimension lookup join with a checked broadcast.

A dimension is broadcast only after one aggregate over it proves it small:
its row count and its payload size in bytes (string lengths plus fixed-width
sizes) must both be under the bounds. The check is a plain partial aggregate
(each task counts its own rows, one tiny final merge), so it never funnels
rows into a single task the way a ``limit`` would; it reads the dimension
once, which is small next to the fact side it saves from a shuffle.

Past the bounds the join is left to a shuffle join on the key; with adaptive
execution on, a fact-side key holding a large share of the rows is split
across tasks by the skew-join rule instead of landing in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


# Bytes per value of fixed-width types. Other types but text and binary have no
# size that one expression gives, so a side that holds them is never broadcast.
_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
          T.DateType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8,
          T.TimestampNTZType: 8, T.DecimalType: 16}


def _row_bytes(schema: T.StructType) -> Column:
    parts = []
    for f in schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)))
        else:
            parts.append(F.lit(_WIDTH[type(f.dataType)]))
    total = F.lit(0)
    for p in parts:
        total = total + p
    return total.cast("bigint")


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, payload bytes) of ``df``, computed by one distributed aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 F.coalesce(F.sum(_row_bytes(df.schema)), F.lit(0)).alias("bytes")).first()
    return int(row["rows"]), int(row["bytes"])


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    if not all(type(f.dataType) in _WIDTH or isinstance(f.dataType, (T.StringType, T.BinaryType))
               for f in df.schema.fields):
        return False
    rows, size = measure(df)
    return rows <= max_rows and size <= max_bytes


def maybe_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                    max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


#: Most keys that are looked up by equality in the scan itself.
LOOKUP_KEYS = 200


def key_lookup(table: DataFrame, keys: DataFrame, key: str, max_keys: int = LOOKUP_KEYS) -> DataFrame:
    """The rows of ``table`` whose ``key`` is among ``keys``.

    The scan gets the range of the keys. Up to ``max_keys`` distinct keys become
    equality tests too, which it holds against each row group's statistics and
    Bloom filter (a long IN list would be pushed as one range); more are joined.
    The keys are computed once either way.
    """
    wanted = keys.select(key).dropna().distinct().checkpoint()
    lo, hi, n = wanted.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    if not n:
        return table.limit(0)
    near = table.filter(F.col(key).between(F.lit(lo), F.lit(hi)))
    if n > max_keys:
        return near.join(wanted, key, "left_semi")
    found = F.lit(False)
    for r in wanted.orderBy(key).collect():
        found = found | (F.col(key) == F.lit(r[0]))
    return near.filter(found)


def lookup_join(fact: DataFrame, dim: DataFrame, on, how: str = "left",
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    return fact.join(maybe_broadcast(dim, max_broadcast_rows, max_broadcast_bytes), on, how)
