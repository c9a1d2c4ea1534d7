"""Helpers shared by the operators: scratch tables, skew-safe joins, word rules."""

from __future__ import annotations

import gc
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierone.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word of licence and benchmark matching: letters, digits and anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A run of anything but ASCII white space.
TOKEN = r"[^\x20\x09-\x0D]+"
#: Most rows a relation may have to be broadcast (a few longs each).
BROADCAST_ROWS = 200_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, computes once.

    Tasks of a lost executor run again and only committed files count, so
    values such as row ids given here stay the same for every later reader.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a scratch table of :func:`materialize`, once all that reads it has been written."""
    spark = table.sparkSession
    home = scratch_path(spark, "").rpartition("/")[0]
    files = spark._jvm.org.apache.hadoop.fs
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        path = files.Path(folder)
        if path.getParent().toUri().getPath() != files.Path(home).toUri().getPath():
            raise ValueError(f"no scratch table: {folder}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs dropped now, not when the driver next runs short of memory.

    Spark drops them once the driver has collected their last reference; a long
    operator calls this between its steps, so that disk holds those of one step.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def words_of(text: Column, pattern: str = WORD) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def unused(name: str, df: DataFrame) -> str:
    """``name``, lengthened until ``df`` has no such column (names differ in case only are the same)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where lambdas in the body use it."""
    return F.transform(F.array(value), body)[0]


def join_checked(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left",
                 rows: int | None = None) -> DataFrame:
    """Null-safe equi-join; ``right`` is broadcast only if counted to be small."""
    rows = right.count() if rows is None else rows
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys])
    side = F.broadcast(renamed) if rows <= BROADCAST_ROWS else renamed
    return left.join(side, on, how).drop(*[f"__r_{k}" for k in keys])


def drop_rows(docs: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """The rows of ``docs`` but those whose ``doc_id`` and text hash are a ``doc_id, key`` of ``gone``, all columns kept."""
    flag, key = unused("__gone", docs), unused("__key", docs)
    marks = materialize(gone.select("doc_id", F.col("key").alias(key)).distinct()
                        .withColumn(flag, F.lit(True)), name)
    marked = join_checked(docs.withColumn(key, F.xxhash64("text")), marks, ["doc_id", key])
    return marked.filter(F.col(flag).isNull()).select(*[f"`{c}`" for c in docs.columns])


def any_one(rows: DataFrame, keys: list[str], columns: list[str], first: list[Column] | None = None) -> DataFrame:
    """``columns`` of one row for each key, the same in every run: the greatest by ``first``, then by its values.

    Columns that have no order (maps) do not decide.
    """
    ordered = [F.col(f"`{f.name}`") for f in rows.schema.fields
               if f.name in columns and not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    return (rows.groupBy(*keys).agg(F.max_by(whole, F.struct(*(first or []), *ordered)).alias("__row"))
            .select("__row.*"))


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str,
                total: int, hot_share: int = 1000) -> DataFrame:
    """Left-join each row with the single record of its group.

    Groups holding over 1/``hot_share`` of all rows number at most
    ``hot_share``, so their records are broadcast; the rest are joined by a
    shuffle in which no key is hot. Rows without a record get nulls.
    """
    extra = [c for c in groups.columns if c not in keys]
    hot = groups.filter(F.col(size) * hot_share > F.lit(total)).withColumn("__hot", F.lit(True))
    cold = groups.filter(F.col(size) * hot_share <= F.lit(total))
    marked = join_checked(rows, hot, keys, rows=0)
    done = marked.filter(F.col("__hot").isNotNull()).drop("__hot")
    rest = marked.filter(F.col("__hot").isNull()).drop("__hot", *extra)
    renamed = cold.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *extra)
    on = reduce(lambda a, b: a & b, [rest[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys])
    rest = rest.join(renamed, on, "left").drop(*[f"__r_{k}" for k in keys])
    return done.unionByName(rest)
