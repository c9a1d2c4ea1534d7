"""Parquet scans and writes.

* Reads always pass the declared schema: partition-column types are pinned
  (integer ``quarter``), an empty partitioned dataset still has a schema, and
  Spark does not need to open footers to infer one.
* Partitioned writes replace only the partitions present in the output
  (dynamic overwrite), so re-running one quarter leaves the others alone.
* Clustered writes range-partition on (partition columns, cluster columns,
  tie-breaker) and sort within partitions in the same order: a large
  partition value spreads over many tasks, each task writes few files, and
  Parquet row-group min/max statistics on the cluster columns let filters skip
  row groups. The sort must lead with the partition columns, otherwise the
  writer re-sorts by them and the clustering order is lost.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierone.session import scratch_path


def read_dataset(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def cluster(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str],
            tie_breakers: Sequence[str] = ()) -> DataFrame:
    keys = [*partition_by, *cluster_by, *tie_breakers]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def bloom_options(columns: Mapping[str, int]) -> dict[str, str]:
    """Writer options: a Bloom filter per row group for each column, for so many distinct values at most.

    A reader that looks for values by equality passes over row groups whose
    filter has none of them, also where the column's ranges tell nothing. The
    writer takes the smallest filter that holds what a row group turned out to have.
    """
    out = {"parquet.bloom.filter.adaptive.enabled": "true"} if columns else {}
    for column, ndv in columns.items():
        out[f"parquet.bloom.filter.enabled#{column}"] = "true"
        out[f"parquet.bloom.filter.expected.ndv#{column}"] = str(ndv)
        out[f"parquet.bloom.filter.fpp#{column}"] = "0.001"         # many keys meet many row groups
    return out


def write_dataset(df: DataFrame, path: str, *, mode: str = "overwrite",
                  partition_by: Sequence[str] = (), observe: Observation | None = None,
                  replace_all: bool = False, bloom: Mapping[str, int] | None = None,
                  options: Mapping[str, str] | None = None) -> None:
    """Write ``df``; if ``observe`` is given, its row count rides along as a metric.

    A partitioned overwrite replaces the partitions it has rows for, or with ``replace_all`` every one.
    ``bloom`` names columns to write Bloom filters for (:func:`bloom_options`).
    """
    if observe is not None:
        df = df.observe(observe, F.count(F.lit(1)).alias("rows"))
    writer = df.write.mode(mode).format("parquet").options(**bloom_options(bloom or {}), **(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by).option(
            "partitionOverwriteMode", "static" if replace_all else "dynamic")
    writer.save(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, by column: cuts lineage, computes once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return read_dataset(df.sparkSession, path, df.schema)


def observed_rows(obs: Observation) -> int:
    return int(obs.get.get("rows", 0))
