"""Hot keys: a key holding a third of the fact rows, dimension past the bound."""

from pyspark.sql import functions as F

from tierone.operators.joins import lookup_join


def test_left_join_splits_a_hot_key_when_not_broadcast(spark):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 30_000
        # A third of all fact rows carry key 0; the rest spread over 10,000 keys.
        fact = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 10_000).alias("cert"),
            F.col("id").alias("v"))
        dim = spark.range(10_000).select(F.col("id").alias("cert"),
                                         F.concat(F.lit("bank-"), F.col("id")).alias("name"))
        joined = lookup_join(fact, dim, "cert", "left", max_broadcast_rows=100)
        got = joined.agg(F.count(F.lit(1)).alias("rows"),
                         F.count("name").alias("matched"),
                         F.sum(F.when(F.col("cert") == 0, 1).otherwise(0)).alias("hot")).first()
        hot = sum(1 for i in range(n) if i % 3 == 0 or i % 10_000 == 0)
        assert (got.rows, got.matched, got.hot) == (n, n, hot)
        joined.collect()                        # run this DataFrame itself: final AQE plan
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
