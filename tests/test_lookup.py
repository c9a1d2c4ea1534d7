"""Point lookups: Bloom filters of the served tables let scans pass over row groups."""

import random

import pytest

from tierone.operators.joins import key_lookup
from tierone.session import scratch_path
from tierone.sources.parquet import write_dataset

ROWS = 800_000


def rows_scanned(df) -> int:
    """Rows of the row groups that the scan did not pass over, once ``df`` has run."""
    def scans(node):
        if node.nodeName().startswith("Scan parquet"):
            yield int(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            yield from scans(children.apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    return sum(scans(plan))


@pytest.fixture(scope="module")
def scattered(spark):
    """The same rows without and with Bloom filters: keys in no order, so ranges tell nothing."""
    df = spark.range(ROWS).selectExpr("id * 7919 % 1000003 AS cert", "id AS v").repartition(4, "v")
    paths = {}
    for name, bloom in (("plain", None), ("bloom", {"cert": ROWS})):
        paths[name] = scratch_path(spark, f"lookup-{name}")
        write_dataset(df, paths[name], bloom=bloom,
                      options={"parquet.block.size": str(16 * 1024), "parquet.enable.dictionary": "false"})
    return paths


def test_few_row_groups_are_read_for_scattered_keys(spark, scattered):
    rng = random.Random(5)
    wanted = [i * 7919 % 1000003 for i in rng.sample(range(ROWS), 25)]
    keys = spark.createDataFrame([(k,) for k in wanted], "cert bigint")
    read = {}
    for name, path in scattered.items():
        found = key_lookup(spark.read.parquet(path), keys, "cert")
        assert sorted(r.cert for r in found.collect()) == sorted(wanted)
        read[name] = rows_scanned(found)
    assert 0 < read["bloom"] < ROWS / 10 and read["plain"] > ROWS / 2


def test_many_keys_are_joined(spark, scattered):
    table = spark.read.parquet(scattered["bloom"])
    keys = table.limit(50).select("cert").unionByName(table.limit(50).select("cert"))
    few = key_lookup(table, keys, "cert", max_keys=10)
    assert "LeftSemi" in few._jdf.queryExecution().optimizedPlan().toString()
    assert few.count() == key_lookup(table, keys, "cert").count() == 50
    none = spark.createDataFrame([(None,)], "cert bigint")
    assert key_lookup(table, none, "cert").count() == key_lookup(table, none.limit(0), "cert").count() == 0
