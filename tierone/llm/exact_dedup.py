"""Exact deduplication by content-defined chunk recipes (DataFrame functions only).

The text without ASCII white space is cut where its own content says so
(``BOUNDARY``), which makes the cuts of equal texts equal and keeps the chunks
of a shared passage equal too. Every chunk becomes a 64-bit hash and a SHA-256
digest. The chunk table is deduplicated to one row for each (hash, digest);
a hash that stands for two digests is told apart by the digest's rank, so an
identifier is verified to stand for one chunk. Two texts are equal when their
ordered identifier lists are equal: only these lists are shuffled, never texts.

Defined results: null text counts as empty, all empty texts are one group;
rows with a null ``doc_id`` take part and lose to any other row of their
group at equal length; repeated rows are rows of their own, and one of several
with the same smallest ``doc_id`` and length stays (the smallest row id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierone.llm.common import any_one, join_checked, join_groups, materialize, unused

SPACE = r"[\x20\x09-\x0D]+"
#: A cut follows three characters of a kind met about once in 100 in running text, 256 to 2,048
#: characters after the last; where none come, the longest chunk is cut.
MIN_CHUNK, MAX_CHUNK = 256, 2048
BOUNDARY = r"[aeou3-6\x{80}-\x{10FFFF}][bghmvw.7-9\x{3000}-\x{FFFF}][aehilt0-4\x{80}-\x{10FFFF}]"


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def chunks_of(norm: Column, boundary: str = BOUNDARY) -> Column:
    pattern = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK - 3}}}?(?:{boundary})|.{{1,{MAX_CHUNK}}}"
    return F.regexp_extract_all(norm, F.lit(pattern), F.lit(0))


def chunk_table(docs: DataFrame, hash_fn=F.xxhash64) -> DataFrame:
    """One row per document: lengths, digest and the ordered (hash, digest) of its chunks."""
    norm = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                       F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
                       normalized(F.col("text")).alias("norm"))
    return norm.select(
        "rid", "doc_id", "n_chars", F.sha2("norm", 256).alias("text_sha256"),
        F.transform(chunks_of(F.col("norm")), lambda c: F.struct(
            hash_fn(c).alias("h"), F.unhex(F.sha2(c, 256)).alias("d"))).alias("chunks"))


def recipes(table: DataFrame) -> DataFrame:
    """``chunks`` replaced by ``recipe``, the ordered list of verified identifiers."""
    store = (table.select(F.explode("chunks").alias("c")).select("c.h", "c.d")
             .groupBy("h", "d").count())
    # A hash with several digests: its chunks are told apart by the digest's place among them.
    shared = (store.groupBy("h").agg(F.count(F.lit(1)).alias("n"),
                                     F.min("d").alias("least"), F.max("d").alias("most"))
              .filter("n > 1").select("h"))
    clashes = materialize(store.join(shared, "h").select("h", "d"), "clashes")
    plain = table.withColumn("recipe", F.transform("chunks", lambda c: F.struct(
        c["h"].alias("h"), F.lit(None).cast("binary").alias("d"))))
    if clashes.isEmpty():
        return plain.drop("chunks")
    told = (table.select("rid", F.posexplode("chunks").alias("i", "c"))
            .join(clashes.select("h", F.col("d").alias("verified")).withColumn("hit", F.lit(1)),
                  (F.col("c.h") == F.col("h")) & (F.col("c.d") == F.col("verified")), "left")
            .groupBy("rid").agg(
                F.max("hit").alias("hit"),
                F.array_sort(F.collect_list(F.struct("i", F.struct(
                    F.col("c.h").alias("h"), F.col("verified").alias("d")).alias("id")))).alias("l"))
            .filter("hit = 1").select("rid", F.col("l.id").alias("told")))
    return (plain.join(told, "rid", "left")
            .withColumn("recipe", F.coalesce("told", "recipe")).drop("told", "chunks"))


def exact_groups(docs: DataFrame, hash_fn=F.xxhash64) -> DataFrame:
    """Every row with the row of its group that stays: rid, doc_id, keep_id, group_size, kept."""
    table = recipes(materialize(chunk_table(docs, hash_fn), "chunks"))
    table = table.withColumn("rkey", F.xxhash64("recipe"))
    total = table.count()
    # Longest original text, then smallest doc_id (null last), then row id.
    best = F.min(F.struct((-F.col("n_chars")).alias("len"), F.col("doc_id").isNull().alias("nul"),
                          F.col("doc_id"), F.col("rid")))
    groups = (table.groupBy("rkey", "recipe")
              .agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
              .filter("group_size > 1")
              .select("rkey", "recipe", "group_size", F.col("best.doc_id").alias("g_keep"),
                      F.col("best.rid").alias("g_rid")))
    groups = materialize(groups, "groups")
    out = join_groups(table, groups, ["rkey", "recipe"], "group_size", total)
    single = F.col("g_rid").isNull()
    return out.select(
        "rid", "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("g_keep")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col("rid") == F.col("g_rid"))).alias("kept"), "text_sha256")


def keep_exact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are found by (doc_id, digest). Where one such pair holds both the row
    that stays and rows that go (a repeated ``doc_id``), its longest text stays,
    of several the greatest row (:func:`any_one`).
    """
    groups = exact_groups(docs.select("doc_id", "text"))
    sha, n_gone, n_kept = (unused(c, docs) for c in ("__sha", "__gone", "__kept"))
    gone = materialize(
        groups.groupBy("doc_id", F.col("text_sha256").alias(sha))
        .agg(F.count_if(~F.col("kept")).alias(n_gone), F.count_if("kept").alias(n_kept))
        .filter(F.col(n_gone) > 0), "gone")
    marked = join_checked(docs.withColumn(sha, F.sha2(normalized(F.col("text")), 256)), gone, ["doc_id", sha])
    out = marked.filter(F.col(n_gone).isNull()).select(*[f"`{c}`" for c in docs.columns])
    if not gone.filter(F.col(n_kept) > 0).isEmpty():
        longest = F.char_length(F.coalesce("text", F.lit("")))
        mixed = any_one(marked.filter(F.col(n_kept) > 0), ["doc_id", sha], docs.columns, [longest])
        out = out.unionByName(mixed)
    return out
