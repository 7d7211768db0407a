"""Session-level helpers: where lineage is cut, and how wide shuffles are."""

from __future__ import annotations

import math
import os
import re
import tempfile
import uuid
import zipfile
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it from the session if needed.

    On a cluster this must be the shared, fault-tolerant folder named by
    ``spark.checkpoint.dir``; we never invent a machine-local one there.  Only a
    local-mode session without the setting (unit tests) gets a fresh temp folder.
    """
    try:
        sc = spark.sparkContext
    except AttributeError:  # Spark Connect: no driver-side context, the server owns the folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the server session")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="rankloom-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set: point it at a shared folder (HDFS/S3/...) "
        "so iterative jobs can cut lineage and survive executor loss"
    )


def shuffle_partitions(spark: SparkSession) -> int:
    """Partition count used for the pre-partitioned, reused frames (edges, nodes, ranks)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def _bytes(text: str) -> int:
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]*)\s*", text)
    return int(m.group(1)) * _UNITS[m.group(2).lower()] if m else 64 << 20


def partitions_for(spark: SparkSession, rows: int, row_bytes: int) -> int:
    """Partition count for ``rows`` rows of about ``row_bytes`` each.

    This is the rule AQE's partition coalescing applies to ordinary shuffles, taken once
    for layouts that are pinned (bucketed) and therefore cannot be coalesced later: the
    advisory partition size, or - with ``parallelismFirst`` (the default) - the total
    spread over the default parallelism when that is smaller, never below the minimum
    partition size.
    """
    conf = spark.conf
    total = rows * row_bytes
    target = _bytes(conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB"))
    if conf.get("spark.sql.adaptive.coalescePartitions.parallelismFirst", "true").lower() == "true":
        try:
            parallelism = spark.sparkContext.defaultParallelism
        except AttributeError:  # no driver-side context
            parallelism = shuffle_partitions(spark)
        floor = _bytes(conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1MB"))
        target = max(min(math.ceil(total / parallelism), target), floor)
    n = max(1, math.ceil(total / target))
    most = int(conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    if n > most:
        raise ValueError(
            f"{n} buckets are needed and spark.sql.sources.bucketing.maxBuckets is {most}: "
            "raise it, or raise spark.sql.adaptive.advisoryPartitionSizeInBytes"
        )
    return n


def session_beside(spark: SparkSession) -> SparkSession:
    """A new session of the same application with the settings of ``spark``: a job may set its
    own shuffle width there while others run."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def adopt(own: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` as a frame of the session ``own`` (planned with its settings)."""
    if df.sparkSession is own:
        return df
    # no row of the session's own, which the optimizer drops
    none = own.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return none.unionByName(df)


def delete_folder(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


class Held(NamedTuple):
    """A written table of a :class:`Scratch` and the scan of it."""

    name: str
    df: DataFrame


class Scratch:
    """Owner of the tables a job writes under the checkpoint folder.

    Everything made through it is known to it: ``drop`` removes one table, ``close`` (or
    leaving the ``with`` block) all that are left, catalog entries and folders.  A frame that
    reads them must not be used after that."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.held: dict[str, bool] = {}  # name -> it is in the catalog

    def _path(self, name: str) -> str:
        return f"{checkpoint_dir(self.spark).rstrip('/')}/tables/{name}"

    def _name(self, tag: str, catalog: bool) -> str:
        name = f"rankloom_{tag}_{uuid.uuid4().hex[:16]}"
        self.held[name] = catalog
        return name

    def written(self, df: DataFrame, tag: str) -> Held:
        """``df`` as Parquet files."""
        name = self._name(tag, False)
        df.write.parquet(self._path(name))
        return Held(name, self.spark.read.schema(df.schema).parquet(self._path(name)))

    def bucketed(self, df: DataFrame, keys: list[str], tag: str, buckets: int) -> Held:
        """``df`` as a table bucketed on ``keys``, one file a bucket.

        The files cut lineage (executor loss re-reads them instead of recomputing earlier
        sweeps) and pin the layout: a bucketed scan reports ``hashpartitioning(keys, n)``,
        which lets later joins and aggregations on ``keys`` run without shuffling this side -
        something a plain ``checkpoint()`` does not keep once adaptive execution is on.  The
        ``repartition`` is dropped by the planner when ``df`` is already partitioned that way.
        """
        name = self._name(tag, True)
        (
            df.repartition(buckets, *keys)
            .write.format("parquet")
            .bucketBy(buckets, *keys)
            .option("path", self._path(name))
            .mode("errorifexists")
            .saveAsTable(name)
        )
        return Held(name, self.spark.table(name))

    def path(self, held: Held) -> str:
        return self._path(held.name)

    def release(self, held: Held) -> None:
        """Keep the files of ``held`` for whoever reads them, without a catalog entry; this
        object no longer owns them."""
        if self.held.pop(held.name):
            self.spark.sql(f"DROP TABLE IF EXISTS {held.name}")

    def drop(self, held: Held | None) -> None:
        if held is not None and held.name in self.held:
            if self.held.pop(held.name):
                self.spark.sql(f"DROP TABLE IF EXISTS {held.name}")
            delete_folder(self.spark, self._path(held.name))

    def close(self) -> None:
        for name in list(self.held):
            self.drop(Held(name, None))

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *exc) -> None:
        self.close()


def new_folder(spark: SparkSession, tag: str) -> str:
    """Path of a folder of its own under the checkpoint folder, for files that a job writes and
    its result reads."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/rankloom_{tag}_{uuid.uuid4().hex[:16]}"


def materialise(df: DataFrame, tag: str, scratch: Scratch | None = None) -> DataFrame:
    """Write ``df`` once as Parquet under the checkpoint folder and return a scan of it: for
    frames that are dear to compute and read more than once.  The files belong to ``scratch``
    where one is given; otherwise they stay for whoever reads the result."""
    if scratch is not None:
        return scratch.written(df, tag).df
    path = new_folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application.

    Functions passed to ``mapInArrow`` and the like are pickled by reference, so a worker
    must be able to import the package; where it is only on the driver's path (a job started
    from a checkout, a notebook) it is sent as a zip file with ``addPyFile``.  Clusters that
    install the package, or pass it with ``--py-files``, lose nothing by this.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="rankloom-code-"), "rankloom.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(home):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(home)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)
