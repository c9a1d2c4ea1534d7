"""Replacing partitions of a served table without a gap for its readers.

New rows are written to a fresh folder; only after that write has committed do
the catalog's partitions point there (``ALTER TABLE ... SET LOCATION``, one
partition at a time, each whole). A write that fails changes nothing, and a
reader that has planned its scan goes on with the files it planned on, which
stay.

Which folder holds each partition is also recorded beside the table, one small
file for each publication, so that a process with an empty catalog finds the
same rows: the record of the highest generation counts. A table has one
publisher at a time; its generations are numbered by it.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierone.sources.parquet import bloom_options

RECORD = "generation bigint, value string, location string"


def _root(spark: SparkSession, db: str) -> str:
    return spark.catalog.getDatabase(db).locationUri.rstrip("/")


def record_path(spark: SparkSession, db: str, table: str) -> str:
    return f"{_root(spark, db)}/_published/{table}"


def published(spark: SparkSession, db: str, table: str) -> tuple[int, dict[str, str]]:
    """(generation, folder by partition value); at most one row for each partition comes back."""
    path = record_path(spark, db, table)
    spark.createDataFrame([], RECORD).write.mode("append").parquet(path)
    record = spark.read.schema(RECORD).parquet(path)
    last = record.agg(F.max("generation").alias("generation"))
    rows = record.join(F.broadcast(last), "generation", "left_semi").collect()
    generation = max((r.generation for r in rows), default=0)
    return generation, {r.value: r.location for r in rows if r.value is not None}


def point(spark: SparkSession, db: str, table: str, column: str, places: dict[str, str],
          gone: Collection[str] = ()) -> None:
    """Make the catalog's partitions of ``table`` read the folders in ``places``."""
    name = f"`{db}`.`{table}`"
    have = {r.partition.split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for value, location in sorted(places.items()):
        spec = f"PARTITION (`{column}` = '{value}')"
        if value in have:
            spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{location}'")
        else:
            spark.sql(f"ALTER TABLE {name} ADD {spec} LOCATION '{location}'")
    for value in sorted(set(gone) & have):
        spark.sql(f"ALTER TABLE {name} DROP PARTITION (`{column}` = '{value}')")
    spark.catalog.refreshTable(f"{db}.{table}")


def publish(spark: SparkSession, db: str, table: str, rows: DataFrame, column: str,
            replaces: Collection[str] | None = None, bloom: Mapping[str, int] | None = None) -> None:
    """Replace the partitions ``replaces`` (values of ``column``; None: all) by ``rows``.

    A replaced partition that gets no rows is dropped. Rows outside the
    partitions named are an error, seen before anything is replaced.
    """
    generation, places = published(spark, db, table)
    folder = f"{_root(spark, db)}/{table}/generation-{generation + 1}-{uuid.uuid4().hex}"
    seen = Observation(f"publish_{table}")
    values = F.collect_set(F.col(column).cast("string"))        # bounded by the partitions
    (rows.observe(seen, values.alias("values")).write.options(**bloom_options(bloom or {}))
     .partitionBy(column).parquet(folder))
    new = {v: f"{folder}/{column}={v}" for v in seen.get.get("values", [])}
    replaces = set(places) | set(new) if replaces is None else set(replaces)
    if set(new) - replaces:
        raise ValueError(f"{table}: rows for {sorted(set(new) - replaces)} are not among {sorted(replaces)}")
    gone = replaces - set(new)
    now = {**{v: p for v, p in places.items() if v not in replaces}, **new}
    # A generation without partitions is recorded by a row without a value.
    record = [(generation + 1, v, p) for v, p in sorted(now.items())] or [(generation + 1, None, None)]
    spark.createDataFrame(record, RECORD).coalesce(1).write.mode("append").parquet(record_path(spark, db, table))
    point(spark, db, table, column, new, gone)
