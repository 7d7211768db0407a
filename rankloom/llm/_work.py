"""Where the operators keep intermediate tables: the shared folder of ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rankloom.session import checkpoint_dir, ship_package


class Workspace:
    """Written tables of one job, under the shared checkpoint folder.

    ``save`` cuts lineage: the frame is written as Parquet (committed task by task, so a lost
    executor costs its tasks only) and read back.  ``drop`` removes a table that no later
    step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, want: str) -> str:
    """``want`` or a longer name that no column of ``df`` has (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while want.lower() in taken:
        want = f"_{want}"
    return want


SLICE = 4 << 20


def slices(batches, most: int = SLICE):
    """The batches in slices of about ``most`` bytes (a larger row is one of its own): for
    functions that turn a batch into Python objects."""
    for batch in batches:
        step = max(1, batch.num_rows * most // max(batch.nbytes, most))
        for lo in range(0, batch.num_rows, step):
            yield batch.slice(lo, step)


def arrow_map(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with the package sent to the Python workers first."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)
