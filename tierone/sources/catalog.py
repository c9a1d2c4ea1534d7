"""Catalog registration and table maintenance (Spark's own catalog).

External tables point at Parquet folders written by the pipeline; dropping
one leaves its files in place, so tables are dropped *before* each rewrite
and re-registered after it. Partitions of a partitioned external table are
discovered with ``recoverPartitions`` (the ``MSCK REPAIR TABLE`` step).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierone.schemas import ddl


def _q(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(db)}{loc}")


def drop_tables(spark: SparkSession, db: str, tables: Sequence[str]) -> None:
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {_q(db)}.{_q(t)}")


def register_external(spark: SparkSession, db: str, table: str, schema: T.StructType,
                      path: str, partition_by: Sequence[str] = (),
                      comment: str | None = None) -> None:
    """``CREATE TABLE ... USING parquet [PARTITIONED BY] LOCATION`` + partition discovery."""
    parts = f"\nPARTITIONED BY ({', '.join(_q(p) for p in partition_by)})" if partition_by else ""
    cmt = f"\nCOMMENT '{comment}'" if comment else ""
    spark.sql(
        f"CREATE TABLE {_q(db)}.{_q(table)} (\n  {ddl(schema)}\n)\nUSING parquet"
        f"{parts}\nLOCATION '{path}'{cmt}")
    if partition_by:
        spark.catalog.recoverPartitions(f"{db}.{table}")


def register_partitioned(spark: SparkSession, db: str, table: str, schema: T.StructType, path: str,
                         column: str, comment: str | None = None) -> None:
    """A table partitioned by ``column`` whose partitions are given places of their own later."""
    cmt = f"\nCOMMENT '{comment}'" if comment else ""
    spark.createDataFrame([], schema).write.mode("append").partitionBy(column).parquet(path)     # the folder
    spark.sql(f"CREATE TABLE {_q(db)}.{_q(table)} (\n  {ddl(schema)}\n)\nUSING parquet"
              f"\nPARTITIONED BY ({_q(column)})\nLOCATION '{path}'{cmt}")


def ensure_external(spark: SparkSession, db: str, table: str, schema: T.StructType, path: str,
                    partition_by: Sequence[str] = (), comment: str | None = None) -> None:
    """Register ``path`` unless this catalog has the table; the folder is made if absent."""
    if not spark.catalog.tableExists(f"{db}.{table}"):
        empty = spark.createDataFrame([], schema).write.mode("append")
        (empty.partitionBy(*partition_by) if partition_by else empty).parquet(path)
        register_external(spark, db, table, schema, path, partition_by, comment)


def set_table_comment(spark: SparkSession, db: str, table: str, comment: str) -> None:
    text = comment.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {_q(db)}.{_q(table)} SET TBLPROPERTIES ('comment' = '{text}')")


def save_table(df: DataFrame, db: str, table: str, mode: str) -> None:
    """Managed-table load: ``overwrite`` replaces (idempotent), ``append`` adds."""
    df.write.mode(mode).format("parquet").saveAsTable(f"{db}.{table}")


def list_tables(spark: SparkSession, db: str) -> list[str]:
    # Catalog metadata (table names), not data.
    return sorted(t.name for t in spark.catalog.listTables(db) if not t.isTemporary)


def table_inventory(spark: SparkSession, db: str) -> DataFrame:
    """``table_id``, ``row_count`` for every table in ``db``, by name."""
    parts = [
        spark.table(f"{db}.{t}").agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
        .select(F.lit(t).alias("table_id"), "row_count")
        for t in list_tables(spark, db)
    ]
    if not parts:
        return spark.createDataFrame([], "table_id string, row_count bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_id")


def table_dictionary(spark: SparkSession, db: str, table: str) -> DataFrame:
    """One row per column: the catalog's descriptions and how many rows fill the column.

    Descriptions are catalog metadata; the counts are one aggregate over the table.
    """
    columns = spark.catalog.listColumns(f"{db}.{table}")
    about = spark.catalog.getTable(f"{db}.{table}").description
    counts = spark.table(f"{db}.{table}").agg(
        *[F.count(F.col(f"`{c.name}`")).alias(f"n{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c.name).alias("column_name"), F.lit(c.description).alias("description"),
                              F.col(f"n{i}").alias("filled")) for i, c in enumerate(columns)])
    return (counts.select(F.explode(rows).alias("c"))
            .select(F.lit(table).alias("table_id"), F.lit(about).alias("table_description"), "c.*"))


def table_location(spark: SparkSession, db: str, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(db)}.{_q(table)}").filter(
        F.col("col_name") == "Location").select("data_type").collect()
    return rows[0][0]


def table_sizes(spark: SparkSession, db: str) -> DataFrame:
    """``table_id``, ``size_kb``: summed Parquet file lengths under each table.

    The binary-file source lists files and returns their lengths without
    reading their content when ``content`` is not selected.
    """
    parts = []
    for t in list_tables(spark, db):
        files = (spark.read.format("binaryFile")
                 .option("pathGlobFilter", "*.parquet")
                 .option("recursiveFileLookup", "true")
                 .load(table_location(spark, db, t)))
        parts.append(files.agg(
            (F.coalesce(F.sum("length"), F.lit(0)) / F.lit(1024.0)).alias("size_kb"))
            .select(F.lit(t).alias("table_id"), "size_kb"))
    if not parts:
        return spark.createDataFrame([], "table_id string, size_kb double")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_id")
