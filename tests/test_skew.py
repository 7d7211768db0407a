"""A key with a third of the rows is split by adaptive execution, not left to one task."""

import pytest
from pyspark.sql import functions as F

from rankloom.operators import graph as G

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "24",
}


@pytest.fixture
def small_partitions(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_graph(spark, hot: str) -> G.Graph:
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("n"), (F.col("id") % 9_001).cast("string")))
    other = F.concat(F.lit("m"), F.col("id").cast("string"))
    edges = spark.range(n).repartition(16).select(key.alias(hot), other.alias("dst" if hot == "src" else "src")).select("src", "dst")
    return G.Graph(edges.select(F.col("src").alias("node")).distinct(), edges)


@pytest.mark.parametrize("hot, query", [("src", G.transition_matrix), ("dst", G.edges_by_id)])
def test_hot_key_is_split(spark, small_partitions, hot, query):
    df = query(hot_graph(spark, hot))
    assert len(df.collect()) == 60_000
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
