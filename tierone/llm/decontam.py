"""Benchmark decontamination by a distributed positional inverted index (DataFrame functions only).

A benchmark item is searched as its windows of ``WINDOW`` consecutive words.
One pass counts how often the corpus uses each benchmark term; each window is
anchored at its rarest term. A second pass stores the index: postings (row,
position) of the terms needed, with the ``WINDOW`` - 1 words on either side of
an anchor, and one length posting per document (the empty term). Search starts
from the anchors' lists, shifts them by the anchor's offset in the window, and
intersects them with the shifted list of the next rarest term, unless that
list is over ``LIST_RATIO`` times as long, when looking at the stored words is
cheaper. What is left is compared word by word (exact phrase matches); where
the words around an anchor hold at least ``NEAR_SHARE`` of a window's terms in
any order it is a proximity match, also if the corpus lacks some of its terms.
Only postings are shuffled, never texts. A text is split into words once in
each of the two passes.

Defined results: null text has no words; an item without words is never found;
equal windows of several items count for each of them; a null ``item_id``
counts as an item but is left out of the list; repeated rows are searched one
by one; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierone.llm.common import ascii_lower, drop_rows, join_checked, let, materialize

#: What lies between words: ASCII but letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
LIST_RATIO = 16
NEAR_SHARE = 0.8
LENGTH = ""                             # the term of length postings; no word is empty


def word_list(text: Column) -> Column:
    """The words of a text, A-Z in lower case: what lies between separators, but for empty ends."""
    def inner(parts: Column) -> Column:
        lead, trail = ((F.element_at(parts, i) == "").cast("int") for i in (1, -1))
        return F.slice(parts, lead + 1, F.greatest(F.size(parts) - lead - trail, F.lit(0)))

    return let(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), inner)


def words(docs: DataFrame) -> DataFrame:
    return docs.withColumn("words", word_list(F.col("text")))


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``item_id, win``: each item's distinct windows."""
    parts = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1))),
        lambda i: F.slice("words", i, size))
    return (words(benchmark.select("item_id", "text")).filter(F.size("words") > 0)
            .select("item_id", F.explode(parts).alias("win")).distinct())


def anchored(wins: DataFrame, docs: DataFrame, ratio: int = LIST_RATIO) -> DataFrame:
    """Distinct windows with the offsets and terms of their rarest and next rarest words.

    Of words that the corpus has: windows that share none with it are left out.
    """
    distinct = materialize(wins.select("win").distinct()
                           .withColumn("wid", F.monotonically_increasing_id()), "decon-windows")
    terms = materialize(distinct.select(F.explode("win").alias("term")).distinct(), "decon-terms")
    # Exploding the expression itself: over a column Spark infers a filter that splits the text twice.
    uses = docs.select(F.explode(word_list(F.col("text"))).alias("term"))
    counts = materialize(join_checked(uses, terms, ["term"], "inner").groupBy("term")
                         .agg(F.count(F.lit(1)).alias("n")), "decon-counts")
    spots = distinct.select("wid", F.posexplode("win").alias("off", "term")).join(counts, "term")
    ranked = (spots.groupBy("wid")
              .agg(F.array_sort(F.collect_list(F.struct("n", "off", "term"))).alias("r")))
    first, second = F.col("r")[0], F.try_element_at("r", F.lit(2))
    use_second = second["n"] <= first["n"] * ratio
    return (distinct.join(ranked, "wid")
            .select("wid", "win", first["term"].alias("term"), first["off"].alias("off"),
                    F.when(use_second, second["term"]).alias("term2"),
                    F.when(use_second, second["off"]).alias("off2")))


def build_index(corpus: DataFrame, wins: DataFrame, size: int = WINDOW) -> DataFrame:
    """Postings ``rid, doc_id, term, pos`` and, for anchors, the words ``ctx`` from ``at`` on."""
    terms = (wins.select("term", F.lit(True).alias("anchor"))
             .unionByName(wins.filter("term2 IS NOT NULL")
                          .select(F.col("term2").alias("term"), F.lit(False).alias("anchor")))
             .groupBy("term").agg(F.max("anchor").alias("anchor"))
             .unionByName(wins.sparkSession.createDataFrame([(LENGTH, False)], "term string, anchor boolean")))
    terms = materialize(terms, "decon-anchors")
    rows = corpus.select("rid", "doc_id", "key", "words", F.posexplode(
        F.concat("words", F.array(F.lit(LENGTH)))).alias("pos", "term"))
    at = F.greatest(F.col("pos") - size + 1, F.lit(0))
    found = join_checked(rows, terms, ["term"], "inner")
    return materialize(found.select(
        "rid", "doc_id", "key", "term", "pos", at.alias("at"),
        F.when(F.col("anchor"), F.slice("words", at + 1, 2 * size - 1)).alias("ctx")), "decon-index")


def search(index: DataFrame, wins: DataFrame, near_share: float = NEAR_SHARE) -> DataFrame:
    """Matches ``rid, start, wid, len, exact`` of the windows in the indexed corpus."""
    hits = (join_checked(index.filter("ctx IS NOT NULL").drop("doc_id", "key"), wins, ["term"], "inner")
            .withColumn("start", F.col("pos") - F.col("off")))
    second = index.filter(F.col("term") != LENGTH).select(
        F.col("rid").alias("rid2"), F.col("term").alias("t2"), F.col("pos").alias("pos2"))
    both = hits.filter("term2 IS NOT NULL").join(
        second, (F.col("rid") == F.col("rid2")) & (F.col("term2") == F.col("t2"))
        & (F.col("start") + F.col("off2") == F.col("pos2")), "left_semi")
    found = F.slice("ctx", F.col("start") - F.col("at") + 1, F.size("win")) == F.col("win")
    exact = (both.unionByName(hits.filter("term2 IS NULL"))
             .filter("start >= at").filter(found).withColumn("exact", F.lit(True)))
    shared = F.size(F.array_intersect("ctx", "win")) >= F.size(F.array_distinct("win")) * near_share
    near = (hits.filter(shared & ~F.coalesce((F.col("start") >= F.col("at")) & found, F.lit(False)))
            .withColumn("exact", F.lit(False)))
    columns = ["rid", "start", "wid", F.size("win").alias("len"), "exact"]
    return exact.select(*columns).unionByName(near.select(*columns))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per document: rid, doc_id, key (a hash of the text), n_words, n_hit, n_items, items_sha256,
    contaminated, and n_near, the distinct windows with a proximity match only."""
    corpus = words(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                               F.xxhash64("text").alias("key"), "text")).drop("text")
    item_windows = materialize(windows(benchmark, size), "decon-items")
    wins = materialize(anchored(item_windows, docs), "decon-anchored")
    index = build_index(corpus, wins, size)
    found = materialize(search(index, wins), "decon-found")
    matches = found.filter("exact")
    # Words inside any occurrence: what each match adds past the end of those before it.
    order = Window.partitionBy("rid").orderBy("start", "len").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    covered = (matches.select("rid", "start", "len").distinct()
               .withColumn("before", F.coalesce(F.max(end).over(order), F.lit(0)))
               .withColumn("new", F.greatest(end - F.greatest("start", "before"), F.lit(0)))
               .groupBy("rid").agg(F.sum("new").cast("long").alias("n_hit")))
    owners = item_windows.join(wins.select("wid", "win"), "win").select("wid", "item_id")
    items = (join_checked(matches.select("rid", "wid").distinct(), materialize(owners, "decon-owners"),
                          ["wid"], "inner")
             .select("rid", "item_id").distinct().groupBy("rid")
             .agg(F.count(F.lit(1)).alias("n_items"),
                  F.array_join(F.array_sort(F.collect_list(F.col("item_id").cast("string"))), ",").alias("ids")))
    near = (found.groupBy("rid", "wid").agg(F.max("exact").alias("e")).filter("NOT e")
            .groupBy("rid").agg(F.count(F.lit(1)).alias("n_near")))
    out = (index.filter(F.col("term") == LENGTH)
           .select("rid", "doc_id", "key", F.col("pos").cast("long").alias("n_words"))
           .join(covered, "rid", "left").join(items, "rid", "left").join(near, "rid", "left"))
    zero = F.lit(0).cast("long")
    return out.select("rid", "doc_id", "key", "n_words", F.coalesce("n_hit", zero).alias("n_hit"),
                      F.coalesce("n_items", zero).alias("n_items"),
                      F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"),
                      (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
                      F.coalesce("n_near", zero).alias("n_near"))


def benchmark_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with all their columns.

    Rows are found by ``doc_id`` and a 64-bit hash of the text: equal texts are
    contaminated alike, so rows that share an id, or have none, are told apart.
    """
    found = contamination(docs.select("doc_id", "text"), benchmark)
    return drop_rows(docs, found.filter("contaminated"), "decon-gone")
