import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("rankloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from rankloom.session import checkpoint_dir

    checkpoint_dir(s)  # uses spark.checkpoint.dir when set, else a temp folder (local only)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fixture_graph(spark):
    """FIXTURES section 2: A->[B,C], B->[C], C->[A,A,D], D->[], E->[A,X]."""
    from rankloom.operators.graph import adjacency_to_graph

    adj = spark.createDataFrame(
        [("A", ["B", "C"]), ("B", ["C"]), ("C", ["A", "A", "D"]), ("D", []), ("E", ["A", "X"])],
        "name string, links array<string>",
    )
    return adjacency_to_graph(adj)
