"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints: XXH64 of every four-word shingle, majority per bit. For radius
``r`` each of the 64 bits is given a nonzero vector of r+1 bits; table ``v``
(one for each nonzero vector) keeps the bits whose vector has an odd product
with ``v``. At most r differing bits always leave some v orthogonal to all of
their vectors, so every pair within the radius meets in some table.

Only distinct fingerprints are compared. A bucket of up to ``SMALL_BUCKET``
is compared whole in one vectorised step that returns a spanning forest of its
links. In a larger bucket members are joined through the points of the ball of
radius r/2 around each (over the bits the table leaves open): a ball of radius
floor(r/2) and one of ceil(r/2) share a point exactly if their members are within
r, so at every point all members are linked with one of the nearer ones, and
the work stays linear in the bucket. Components are found by
minimum-label steps with pointer jumping over written tables.

Defined results: null or empty text has fingerprint zero and links like any
other; a null ``doc_id`` never names a component unless all members are null;
rows that share a ``doc_id`` are separate rows of their fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierone.llm.common import any_one, drop_rows, join_checked, join_groups, materialize, unused
from tierone.llm.numeric import text_groups

SHINGLE = 4
RADIUS = 4
SEED = 42
SMALL_BUCKET = 1024


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words])
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    starts = [0, *ends[: n - 1].tolist()]
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)),
                         dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):     # bounded memory for very long texts
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, ``key`` (a hash of the text) and fingerprint ``fp`` (a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle) for _, texts in text_groups(batch, "text") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"),
                 pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "key", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
            .mapInArrow(run, f"doc_id {kind}, key long, fp long"))


def covering_masks(radius: int = RADIUS) -> list[int]:
    """One 64-bit mask for each nonzero vector of radius+1 bits."""
    vectors = range(1, 2 ** (radius + 1))
    owner = [1 + bit % len(vectors) for bit in range(64)]
    return [sum(1 << b for b, m in enumerate(owner) if (m & v).bit_count() % 2) for v in vectors]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(members: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Each member's least component member, over the links within one bucket."""
    n = len(members)
    label = np.full(n, -1)
    bits = members.view(np.uint64)
    for root in range(n):
        if label[root] >= 0:
            continue
        label[root], front = root, [root]
        while front:
            at = front.pop()
            near = (label < 0) & (np.bitwise_count(bits ^ bits[at]) <= radius)
            label[near] = root
            front.extend(np.flatnonzero(near).tolist())
    linked = label != np.arange(n)
    return members[linked], members[label[linked]]


def links(fps: DataFrame, radius: int = RADIUS, small: int = SMALL_BUCKET) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp`` that connect all within the radius."""
    masks = [_signed(m) for m in covering_masks(radius)]
    tables = fps.select("fp", F.posexplode(F.array(*[F.lit(m) for m in masks])).alias("t", "mask"))
    tables = tables.select("fp", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    # Buckets of one member are gone before anything is gathered.
    sizes = (tables.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("lo"))
             .filter("n > 1"))
    # Spark sizes the exploded rows by the table before and would broadcast all of them.
    members = materialize(tables.join(sizes.hint("merge"), ["t", "key"]), "sim-buckets")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_forest(np.sort(bucket.values.to_numpy()), radius)
                     for bucket in batch.column("fps")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([f[side] for f in found] or [np.empty(0, np.int64)]))
                 for side in (0, 1)], names=["a", "b"])

    near = (members.filter(F.col("n") <= small).groupBy("t", "key")
            .agg(F.collect_list("fp").alias("fps")).select("fps").mapInArrow(within, "a long, b long"))
    large = members.filter(F.col("n") > small)
    if not large.isEmpty():
        free = [[b for b in range(64) if not m >> b & 1] for m in covering_masks(radius)]
        flips = [[(_signed(sum(1 << b for b in c)), k <= radius // 2) for k in range((radius + 1) // 2 + 1)
                  for c in combinations(bits, k)] for bits in free]
        balls = fps.sparkSession.createDataFrame(
            [(t, x, near) for t, f in enumerate(flips) for x, near in f], "t int, flip long, near boolean")
        points = (large.join(F.broadcast(balls), "t")
                  .select("t", "key", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), "near"))
        centre = (points.groupBy("t", "key", "point")
                  .agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("b"), F.count(F.lit(1)).alias("m"))
                  .filter("m > 1 and b is not null"))
        star = (points.join(centre, ["t", "key", "point"]).filter("fp != b")
                .select(F.col("fp").alias("a"), "b"))
        near = near.unionByName(star.distinct())
    return near.distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``a, b``; root is the least node reachable.

    Labels only fall, so the rounds end; their number grows with the logarithm of a component's width.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both, "cc-edges")
    label = materialize(both.groupBy(F.col("a").alias("node"))
                        .agg(F.least(F.min("b"), F.col("node")).alias("root")), "cc")
    while True:
        # The least label around each node, offered to the node and to its present root.
        around = (both.join(label.withColumnRenamed("node", "b"), "b")
                  .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("low")))
        seen = label.join(around, "node").withColumn("new", F.least("root", "low"))
        seen = materialize(seen, "cc-seen")
        offer = (seen.select("node", "new").unionByName(
            seen.select(F.col("root").alias("node"), "new")).groupBy("node").agg(F.min("new").alias("new")))
        offer = materialize(offer, "cc-offer")
        # Pointer jumping: take the label of one's label.
        jump = offer.select(F.col("node").alias("new"), F.col("new").alias("far"))
        moved = (offer.join(jump, "new", "left")
                 .select("node", F.least("new", F.coalesce("far", "new")).alias("root")))
        moved = materialize(moved, "cc")
        changed = moved.join(label.withColumnRenamed("root", "old"), "node").filter("root != old")
        label = moved
        if changed.isEmpty():
            return label


def near_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                small: int = SMALL_BUCKET) -> DataFrame:
    """doc_id, key, fp, component_id and ``root`` (the component's least fingerprint) of every row of ``docs``."""
    table = materialize(fingerprints(docs, shingle), "sim-fp")
    total = table.count()
    distinct = materialize(table.groupBy("fp").agg(
        F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n")), "sim-distinct")
    label = components(links(distinct.select("fp"), radius, small))
    named = (distinct.join(label.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("root", F.coalesce("root", "fp")))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("members"))
    least = materialize(least, "sim-roots")
    named = join_groups(materialize(named, "sim-named"), least, ["root"], "members", total)
    groups = materialize(named.select("fp", "root", "component_id", "n"), "sim-groups")
    return (join_groups(table, groups, ["fp"], "n", total)
            .select("doc_id", "key", "fp", "component_id", "root"))


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns.

    The row with the least ``doc_id`` stays (null last), of several the one
    whose text has the least hash; of rows equal in both, one (:func:`any_one`).
    """
    groups = materialize(near_groups(docs.select("doc_id", "text"), shingle, radius), "sim-rows")
    total = groups.count()
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")
    kept = materialize(groups.groupBy("root").agg(
        F.min(place).alias("kept"), F.count(F.lit(1)).alias("members")).filter("members > 1"), "sim-kept")
    rows = join_groups(groups, kept, ["root"], "members", total).filter(F.col("kept").isNotNull())
    gone = rows.filter(~(F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("key") == F.col("kept.key"))))
    left = drop_rows(docs, gone, "sim-gone")
    again = (groups.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1"))
    again = materialize(again.select("doc_id", "key"), "sim-again")
    if again.isEmpty():
        return left
    key = unused("__key", docs)
    several = join_checked(left.withColumn(key, F.xxhash64("text")),
                           again.withColumnRenamed("key", key), ["doc_id", key], "inner")
    return drop_rows(left, again, "sim-several").unionByName(any_one(several, ["doc_id", key], docs.columns))
