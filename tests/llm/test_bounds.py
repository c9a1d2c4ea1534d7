"""Former caps: long overlaps, odd radii in large buckets, the number of shards, places within a shard, samples."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierone.llm import mixing, pii, simhash
from tierone.llm.boosting import SLOTS, BoostedTrees


def test_candidates_are_compared_with_every_interval():
    rng = random.Random(1)
    for _ in range(300):
        spans = [(a, a + rng.randint(1, 40), "email") for a in (rng.randrange(120) for _ in range(rng.randint(0, 20)))]
        covered = pii._merged(spans)
        assert {i for a, b in covered for i in range(a, b)} == {i for a, b, _ in spans for i in range(a, b)}
        assert all(b <= c for (_, b), (c, _) in zip(covered, covered[1:], strict=False))
        for _ in range(20):
            a = rng.randrange(160)
            b = a + rng.randint(1, 9)
            assert pii._clear(covered, a, b) == all(e <= a or s >= b for s, e, _ in spans)


@pytest.mark.parametrize("radius", [1, 3, 4])
def test_large_buckets_at_any_radius(spark, radius):
    rng = random.Random(radius)
    marks = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(6):
            mark = centre
            for bit in rng.sample(range(64), rng.randint(0, radius + 1)):
                mark ^= 1 << bit
            marks.add(mark)
    marks = sorted(simhash._signed(m) for m in marks)
    fps = spark.createDataFrame([(m,) for m in marks], "fp long")
    got = {(r.a, r.b) for r in simhash.links(fps, radius, small=1).collect()}

    def apart(a, b):
        return ((a ^ b) & (2**64 - 1)).bit_count()

    def classes(edges):
        root = {m: m for m in marks}
        for a, b in edges:
            low, high = sorted((root[a], root[b]))
            root = {m: low if r == high else r for m, r in root.items()}
        return root

    assert all(apart(a, b) <= radius for a, b in got)
    assert classes(got) == classes([(a, b) for a in marks for b in marks if a < b and apart(a, b) <= radius])


def test_shards_grow_with_the_words():
    assert [mixing.shards_for(n * mixing.SHARD_WORDS) for n in (0, 1, 8, 8.5, 100)] == [8, 8, 8, 16, 128]


def test_copies_have_a_place_within_their_shard(spark):
    docs = spark.createDataFrame(
        [(i, "w " * (i % 9), "a" if i % 10 else "b") for i in range(200)], "doc_id long, text string, source string")
    mixed = mixing.mix(docs, shards=4)
    rows = mixing.shard_order(mixed).collect()
    own = {r.doc_id: (r.shards, r.places) for r in mixed.select(
        "doc_id", "shards", mixing.places(F.col("shards"), F.col("doc_id")).alias("places")).collect()}
    assert all((own[r.doc_id][0][r.copy], own[r.doc_id][1][r.copy]) == (r.shard, r.place) for r in rows)
    assert len(rows) == sum(len(s) for s, _ in own.values())
    assert len({(r.shard, r.place) for r in rows}) == len(rows)


def test_personal_data_is_learned_from_every_document(spark):
    rng = random.Random(11)
    texts = [f"mail {rng.choice('abc')}{i}@host{i % 7}.org or call +1 {200 + i % 700} 555 {1000 + i}" for i in range(9000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    table = pii.training_table(docs).cache()
    want = sum(len(pii.training_rows(t)) for t in [*texts, *pii.prototypes()])
    assert table.agg({"n": "sum"}).first()[0] == want
    trees = BoostedTrees(trees=1, depth=1).fit(table, 0.5, pii.FEATURES)
    held = trees.steps(table)
    assert held[:, 2:].sum() == want            # every row is in the sums
    # The first split is the best one over all rows.
    rows = table.collect()
    code = np.array([list(r.code) for r in rows])
    y, n = np.array([r.y for r in rows]), np.array([r.n for r in rows])
    gains = {}
    for f in range(pii.FEATURES):
        for k in range(SLOTS - 1):
            sides = [(code[:, f] <= k), (code[:, f] > k)]
            if all((n * s).sum() for s in sides):
                gains[f, k] = sum(((n * (0.5 - y))[s].sum()) ** 2 / ((n * 0.25)[s].sum() + 1.0) for s in sides)
    tree = trees.nodes[0]
    assert abs(gains[tree.feature[0], tree.slot[0]] - max(gains.values())) < 1e-6 * max(gains.values())
    table.unpersist()
