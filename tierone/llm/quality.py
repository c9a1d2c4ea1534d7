"""Quality classifier by importance resampling.

Two generative models of hashed n-grams (single tokens and neighbouring
pairs, punctuation included) are counted: the raw one over every document, the
target one over labelled documents of good quality that are not toxic. A
document's log weight is the sum over its n-grams of log(target / raw), where
both counts carry ``PRIOR`` pseudo-counts in proportion to the raw model, so
that rare n-grams say little. Adding Gumbel noise to the log weights and
keeping the top k draws k documents without replacement in proportion to
their weights. k is how many documents weigh at least as much as all but
``CLEAN_LOSS`` of the clean labelled documents held back from the fit.

A few toxic words weigh little in a sum over a whole text, so a second ratio
is kept apart: how much more often a token occurs in labelled toxic documents
than in clean ones, counted once per document, so that no single text speaks
loud, and in the less harmful of two hashed buckets, since a token that shares
a bucket with a toxic one hardly shares both. A document's ``harm`` is the largest such log ratio of its tokens. It
isn't drawn from at all where that exceeds ``HARM`` and the harm
of all but ``HARM_LOSS`` of the clean documents held back.

At most ``LABELS`` labelled documents (least hash of ``doc_id`` first) are
used; half of them, by hash, fit the models and half set k and the harm limit. Raw counts,
scores and the draw cover every row and every whole text. Noise is a hash of
``doc_id``, so reruns agree.

Defined results: null or empty text weighs 0 and has harm 0; repeated rows share weight and
noise, and ties with the k-th key all stay; without clean labels all rows
stay, and without toxic ones harm is 0; labels that disagree count as the worse one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierone.llm.common import drop_rows, join_checked, materialize
from tierone.llm.numeric import mix64, text_groups, tokens

SINGLES, PAIRS = 1 << 16, 1 << 18
SIZE = SINGLES + PAIRS
PRIOR = 20.0
#: Pseudo-documents of either kind in a token's harm, and the least harm that counts.
HARM_PRIOR, HARM = 3.0, float(np.log(2))
LABELS = 20_000
CLEAN_LOSS, HARM_LOSS = 0.005, 0.001
SEED = 42


def grams(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text number of every n-gram of the texts, single tokens first, and the
    other bucket of these."""
    h, owner = tokens(texts, punctuation=True)
    single = (h & np.uint64(SINGLES - 1)).astype(np.int64)
    pair = (mix64(h[:-1] * np.uint64(3) + h[1:]) & np.uint64(PAIRS - 1)).astype(np.int64) + SINGLES
    inside = owner[1:] == owner[:-1]
    return (np.concatenate((single, pair[inside])),
            np.concatenate((owner, owner[1:][inside])),
            (h >> np.uint64(40) & np.uint64(SINGLES - 1)).astype(np.int64) + SINGLES)


def labelled(labels: DataFrame, bound: int = LABELS, seed: int = SEED) -> DataFrame:
    """At most ``bound`` labelled ids: ``clean``, ``toxic``, and ``fit`` (else held back)."""
    one = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
           .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")))
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    toxic = F.coalesce(F.col("toxic") == 1, F.lit(False))
    return (one.orderBy(order, "doc_id").limit(bound)
            .select("doc_id", ((F.col("quality") == 1) & ~toxic).alias("clean"), toxic.alias("toxic"),
                    (F.pmod(order, F.lit(2)) == 0).alias("fit")))


def fit(docs: DataFrame, known: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """log(target / raw) of every bucket and harm of either bucket of single tokens.

    Their size does not depend on the data.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Occurrences anywhere and in clean documents; clean and toxic documents with a
        # token of either bucket, and at SIZE all of them.
        raw, target, clean, toxic = np.zeros((4, SIZE + 1), np.int64)
        for batch in batches:
            marks = np.array(batch.column("mark").to_pylist(), dtype=np.int8)
            for at, texts in text_groups(batch, "text"):
                g, owner, other = grams(texts)
                mark = marks[at:at + len(texts)]
                raw += np.bincount(g, minlength=SIZE + 1)
                target += np.bincount(g[mark[owner] == 1], minlength=SIZE + 1)
                for docs_with, kind in ((clean, 1), (toxic, 2)):
                    at_token = owner[:len(other)]
                    of = mark[at_token] == kind
                    for bucket in (g[:len(other)], other):
                        once = np.unique(at_token[of] * SIZE + bucket[of]) % SIZE
                        docs_with += np.bincount(once, minlength=SIZE + 1)
                    docs_with[SIZE] += (mark == kind).sum()
        seen = np.flatnonzero(raw + clean + toxic)
        for k in range(0, len(seen), 50_000):
            s = seen[k:k + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (s, raw[s], target[s], clean[s], toxic[s])],
                names=["g", "raw", "target", "clean", "toxic"])

    marks = (known.filter("fit AND (clean OR toxic)")
             .select("doc_id", F.when(F.col("clean"), 1).otherwise(2).cast("byte").alias("mark")))
    marked = join_checked(docs.select("doc_id", "text"), marks, ["doc_id"])
    counts = (marked.select("text", F.coalesce("mark", F.lit(0).cast("byte")).alias("mark"))
              .mapInArrow(run, "g long, raw long, target long, clean long, toxic long")
              .groupBy("g").agg(*[F.sum(c).alias(c) for c in ("raw", "target", "clean", "toxic")]))
    # One row per bucket, SIZE + 1 at most, whatever the corpus.
    table = counts.toPandas()
    raw, target, clean, toxic = np.zeros((4, SIZE + 1))
    for into, column in ((raw, "raw"), (target, "target"), (clean, "clean"), (toxic, "toxic")):
        into[table["g"]] = table[column]
    ratio = np.zeros(SIZE)
    for part in (slice(0, SINGLES), slice(SINGLES, SIZE)):
        if target[part].sum():
            expected = raw[part] * (target[part].sum() / raw[part].sum())
            ratio[part] = np.log((target[part] + PRIOR) / (expected + PRIOR))
    harm = np.zeros(2 * SINGLES)
    if clean[SIZE] and toxic[SIZE]:
        # Both kinds as if there were as many documents of the one as of the other.
        few = min(clean[SIZE], toxic[SIZE])
        harm = np.log((toxic[:2 * SINGLES] * (few / toxic[SIZE]) + HARM_PRIOR)
                      / (clean[:2 * SINGLES] * (few / clean[SIZE]) + HARM_PRIOR))
    return ratio, harm


def scores(docs: DataFrame, ratio: np.ndarray, harm: np.ndarray) -> DataFrame:
    """doc_id, key (a hash of the text), n_grams, log_weight and harm of every row."""
    held = docs.sparkSession.sparkContext.broadcast((ratio.astype(np.float32), harm.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, harms = held.value
        for batch in batches:
            weight, worst = np.zeros((2, batch.num_rows))
            count = np.zeros(batch.num_rows, np.int64)
            for at, texts in text_groups(batch, "text"):
                g, owner, other = grams(texts)
                n = len(texts)
                weight[at:at + n] = np.bincount(owner, weights=table[g], minlength=n)
                count[at:at + n] = np.bincount(owner, minlength=n)
                np.maximum.at(worst[at:at + n], owner[:len(other)],
                              np.minimum(harms[g[:len(other)]], harms[other]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(count), pa.array(weight),
                 pa.array(worst)], names=["doc_id", "key", "n_grams", "log_weight", "harm"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
            .mapInArrow(run, f"doc_id {kind}, key long, n_grams long, log_weight double, harm double"))


def kth_largest(rows: DataFrame, column: str, k: int, bins: int = 1024) -> float:
    """The k-th largest value, by histograms that narrow down to a few thousand rows."""
    lo, hi = rows.agg(F.min(column), F.max(column)).first()
    above = 0                           # rows over hi
    while True:
        inside = rows.filter(F.col(column).between(lo, hi))
        if lo == hi:
            return lo
        spot = F.least(F.floor((F.col(column) - lo) / ((hi - lo) / bins)), F.lit(bins - 1))
        counts = inside.groupBy(spot.alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        for row in sorted(counts, key=lambda r: -r["b"]):
            if above + row["n"] >= k:
                lo, hi, n = row["lo"], row["hi"], row["n"]
                break
            above += row["n"]
        if n <= 4096:
            few = rows.filter(F.col(column).between(lo, hi)).select(column).collect()
            return sorted((r[0] for r in few), reverse=True)[k - above - 1]


def select(docs: DataFrame, labels: DataFrame, seed: int = SEED) -> DataFrame:
    """Every row with its log weight, harm, noisy key and whether it is kept."""
    known = materialize(labelled(labels, seed=seed), "quality-labels")
    scored = materialize(scores(docs, *fit(docs, known)), "quality-scores")
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), F.col("doc_id")), 11).cast("double")
         + 0.5) / float(2**53)
    keyed = scored.withColumn("noisy", F.col("log_weight") - F.log(-F.log(u)))
    held_back = join_checked(scored, known.filter("clean AND NOT fit").select("doc_id"), ["doc_id"], "inner")
    least, most = held_back.select(
        F.expr(f"percentile_approx(log_weight, {CLEAN_LOSS}, 100000)"),
        F.expr(f"percentile_approx(harm, {1 - HARM_LOSS}, 100000)")).first()
    if least is None:
        return keyed.withColumn("kept", F.lit(True))
    harmless = F.col("harm") <= max(most, HARM)
    k = scored.filter((F.col("log_weight") >= least) & harmless).count()
    return keyed.withColumn(
        "kept", harmless & (F.col("noisy") >= kth_largest(keyed.filter(harmless), "noisy", k)))


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The kept rows of ``docs`` with all their columns."""
    chosen = select(docs.select("doc_id", "text"), labels)
    return drop_rows(docs, chosen.filter(~F.col("kept")), "quality-gone")
