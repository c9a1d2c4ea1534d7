"""Mixing sources to target weights (DataFrame functions only).

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating,
and share all words; a target stops at ``MAX_EPOCHS`` times its source's size
and the excess is reshared by weight. Water-filling gives the fixed point in
one sorted pass over the table of sources.

Blocks: each source's documents are dealt by hash into about sqrt(documents)
permuted blocks. A source takes whole passes over all blocks, then the first
blocks of one more permutation, and of the last block documents in hash order
up to the word where its target is met.

Splitting tree: the root holds the exact block quota of every source. A node
halves its shards and draws the left half's blocks per source from the
multivariate hypergeometric distribution (source by source, by inverse
distribution function over the mean +- 12 standard deviations, past which lies
under 1e-30); the rest goes right. A leaf's quotas say which disjoint range of
each source's permuted blocks the shard reads. All draws are hashes of a seed
and the node, so reruns agree.

Defined results: null text has size 0; a source of size 0 has target 0;
a null source is a source of its own; rows alike in every column take like
amounts; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierone.llm.common import TOKEN, join_checked, let, materialize

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Shards double from this number until each takes at most SHARD_WORDS words.
SHARDS = 8
SHARD_WORDS = 1 << 26
SEED = 42


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKEN)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size`` with ``target`` added; one row per source."""
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    cap = F.col("source_size") * MAX_EPOCHS
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = (sources.withColumn("weight", weight)
              .withColumn("ratio", cap / F.col("weight")))
    before = F.coalesce(F.sum(cap).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything)
    # The level rises while sources are capped and falls afterwards: its maximum is the answer.
    level = F.max("fill").over(everything)
    return (ranked.withColumn("fill", (total - before) / rest)
            .withColumn("target", F.least(cap.cast("double"), level * F.col("weight")))
            .drop("ratio", "fill", "weight"))


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts only."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / float(2**53)


def hypergeometric(good: Column, total: Column, draws: Column, u: Column) -> Column:
    """How many of ``good`` among ``total`` are in ``draws`` taken without return."""
    lo = F.greatest(F.lit(0).cast("long"), draws + good - total)
    hi = F.least(good, draws)
    n = F.greatest(total, F.lit(1)).cast("double")
    share = good / n
    mean = draws * share
    spread = F.lit(12) * F.sqrt(F.greatest(
        mean * (1 - share) * (total - draws) / F.greatest(n - 1, F.lit(1.0)), F.lit(0.0))) + 20
    first = F.greatest(lo, F.floor(mean - spread))
    last = F.least(hi, F.ceil(mean + spread))

    def step(k: Column) -> Column:      # log of the weight of k over that of k - 1
        k1 = k - 1
        return (F.log((good - k1).cast("double")) + F.log((draws - k1).cast("double"))
                - F.log(k.cast("double")) - F.log((total - good - draws + k).cast("double")))

    inner = F.when(last > first, F.sequence(first + 1, last)).otherwise(
        F.array().cast("array<bigint>"))
    start = F.struct(F.lit(0.0).alias("log"), F.lit(1.0).alias("sum"))
    mass = F.aggregate(inner, start, lambda a, k: F.struct(
        (a["log"] + step(k)).alias("log"),
        (a["sum"] + F.exp(a["log"] + step(k))).alias("sum")))["sum"]
    aim = F.struct(F.lit(0.0).alias("log"), F.lit(1.0).alias("sum"), first.alias("at"))
    return let(u * mass, lambda want: F.aggregate(inner, aim, lambda a, k: F.struct(
        (a["log"] + step(k)).alias("log"),
        (a["sum"] + F.exp(a["log"] + step(k))).alias("sum"),
        F.when(a["sum"] < want, k).otherwise(a["at"]).alias("at")))["at"])


def split_tree(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``source, quota`` to ``source, shard, quota``; shards (a power of two) are equally large.

    One row per node holds the node's quota of each source, ordered by name.
    """
    node = quotas.groupBy().agg(F.array_sort(F.collect_list(
        F.struct(F.col("source").isNull().alias("nul"), F.col("source"), F.col("quota"))))
        .alias("all")).select(F.lit(0).alias("shard"), "all")
    width = shards
    while width > 1:
        total = F.aggregate("all", F.lit(0).cast("long"), lambda a, x: a + x["quota"])
        node = node.withColumn("total", total).withColumn("want", F.expr("total div 2"))
        # Draws of a source are conditional on those of the sources before it.
        begin = F.struct(F.col("want").alias("draws"), F.col("total").alias("pool"),
                         F.array().cast("array<bigint>").alias("left"))

        level = F.lit(width)

        def draw(a: Column, x: Column) -> Column:
            got = hypergeometric(x["quota"], a["pool"], a["draws"],  # noqa: B023 - used at once
                                 uniform(F.lit(seed), level, F.col("shard"), x["source"]))  # noqa: B023
            return F.aggregate(F.array(got), a, lambda acc, g: F.struct(
                (acc["draws"] - g).alias("draws"), (acc["pool"] - x["quota"]).alias("pool"),
                F.concat(acc["left"], F.array(g)).alias("left")))

        node = materialize(node.withColumn("left", F.aggregate("all", begin, draw)["left"]),
                           "mix-node")
        half = width // 2

        def side(count, at, node=node):
            kept = F.zip_with("all", "left", lambda x, n: F.struct(
                x["nul"].alias("nul"), x["source"].alias("source"), count(x, n).alias("quota")))
            return node.select((F.col("shard") + at).alias("shard"), kept.alias("all"))

        node = side(lambda x, n: n, 0).unionByName(side(lambda x, n: x["quota"] - n, half))
        width = half
    return (node.select("shard", F.explode("all").alias("x"))
            .select("x.source", "shard", F.col("x.quota").alias("quota")))


def shards_for(words: float) -> int:
    """The number of shards for a mix of so many words: a power of two."""
    shards = SHARDS
    while shards * SHARD_WORDS < words:
        shards *= 2
    return shards


def plan(docs: DataFrame, shards: int | None = None, seed: int = SEED):
    """(documents with ``size`` and block, block table) of the mix of ``docs``."""
    counts = materialize(docs.groupBy("source").agg(
        F.ceil(F.sqrt(F.count(F.lit(1)))).alias("__blocks")), "mix-counts")
    sized = join_checked(docs, counts, ["source"], "inner")
    sized = (sized.withColumn("__size", word_count(F.col("text")))
             .withColumn("__hash", F.xxhash64(F.lit(seed), F.col("doc_id")))
             .withColumn("__block", F.pmod(F.col("__hash"), F.col("__blocks"))))
    blocks = materialize(sized.groupBy("source", "__block").agg(
        F.sum("__size").alias("words")), "mix-blocks")
    goal = materialize(targets(blocks.groupBy("source").agg(
        F.sum("words").alias("source_size"))), "mix-targets")
    if shards is None:
        shards = shards_for(goal.agg(F.sum("target")).first()[0] or 0)
    goal = (goal.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(
                F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
            .withColumn("rest", F.round("target").cast("long")
                        - F.col("whole") * F.col("source_size")))
    blocks = join_checked(blocks, goal, ["source"], "inner")
    # The last pass reads blocks in a permutation of its own until ``rest`` words are met.
    order = Window.partitionBy("source").orderBy(F.xxhash64(
        F.lit(seed), F.lit("block"), F.col("__block")), "__block")
    before = F.sum("words").over(order) - F.col("words")
    blocks = (blocks.withColumn("left", F.greatest(F.col("rest") - before, F.lit(0)))
              .withColumn("place", F.row_number().over(order) - 1)
              .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("source"))))
    blocks = materialize(blocks.withColumn("last", F.least("left", "words")), "mix-plan")
    drawn = (F.col("last") > 0).cast("long")
    quotas = blocks.groupBy("source").agg(F.sum(F.col("whole") + drawn).alias("quota"))
    ranges = split_tree(quotas, shards, seed)
    # Where each shard's range of a source's blocks begins.
    ranges = (ranges.groupBy("source")
              .agg(F.array_sort(F.collect_list(F.struct("shard", "quota"))).alias("r")))
    ranges = ranges.select("source", F.transform("r", lambda x, i: F.aggregate(
        F.slice("r", 1, i), F.lit(0).cast("long"), lambda a, y: a + y["quota"])).alias("begins"))
    blocks = join_checked(blocks, materialize(ranges, "mix-ranges"), ["source"], "inner")
    copies = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("whole") + drawn - 1),
        lambda e: F.size(F.filter("begins", lambda b: b <= e * F.col("n") + F.col("place"))) - 1)
    copies = F.when(F.col("whole") + drawn > 0, copies).otherwise(F.array().cast("array<int>"))
    # Prefixed, so that no column of the documents clashes.
    return sized, blocks.select("source", "__block", *[
        F.col(c).alias(f"__{c}") for c in ("source_size", "target", "whole", "words", "last")],
        copies.alias("__shards"))


def mix(docs: DataFrame, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target, taken and its copies' shards.

    ``shards`` lists the shard of each copy (their number is a parameter or
    derived from the words taken); the local shuffle orders a shard's copies
    by their :func:`places`, see :func:`shard_order`.
    """
    given = [f"`{c}`" for c in docs.columns if c not in ("size", "source_size", "target", "taken", "shards")]
    sized, blocks = plan(docs.select(*given), shards, seed)
    rows = join_checked(sized, blocks, ["source", "__block"], "inner")
    size, last, whole = F.col("__size"), F.col("__last"), F.col("__whole")

    def result(frame: DataFrame, part: Column) -> DataFrame:
        copies = F.col("__shards")
        return frame.select(
            *given, size.alias("size"), F.col("__source_size").alias("source_size"),
            F.col("__target").alias("target"), (whole * size + part).alias("taken"),
            F.when((last == 0) | (part > 0), copies).otherwise(
                F.slice(copies, F.lit(1), whole.cast("int"))).alias("shards"))

    cut = (last > 0) & (last < F.col("__words"))
    entire = result(rows.filter(~cut), F.when(last > 0, size).otherwise(0))
    # One block per source is cut: its documents in hash order, the last one at a word.
    order = Window.partitionBy("source", "__block").orderBy("__hash", "doc_id", "__size")
    before = F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - size
    partly = result(rows.filter(cut).withColumn("__before", before),
                    F.least(size, F.greatest(last - F.col("__before"), F.lit(0))))
    return entire.unionByName(partly)


def places(shards: Column, doc_id: Column, seed: int = SEED) -> Column:
    """Each copy's key in the shuffle within its shard."""
    return F.transform(shards, lambda shard, copy: F.xxhash64(F.lit(seed), shard, copy, doc_id))


def shard_order(mixed: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per copy with ``shard`` and ``place``, the key of the shuffle within the shard."""
    copies = F.arrays_zip(F.col("shards").alias("shard"), places(F.col("shards"), F.col("doc_id"), seed).alias("place"))
    return (mixed.select("*", F.posexplode(copies).alias("copy", "at"))
            .select("*", "at.shard", "at.place").drop("at"))
