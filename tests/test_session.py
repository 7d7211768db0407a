"""Session helpers: checkpoint folder, owned tables, sessions beside the caller's."""

import os

from pyspark.sql import functions as F

from rankloom import session as S


def test_checkpoint_dir_is_set(spark):
    d = S.checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()


def test_bucketed_table_keeps_hash_partitioning(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with S.Scratch(spark) as scratch:
            left, right = (scratch.bucketed(df, ["k"], "probe", 4).df for _ in range(2))
            plan = left.join(right, "k")._jdf.queryExecution().executedPlan().toString()
            assert left.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2


def test_scratch_removes_its_own_tables_only(spark, tmp_path):
    df = spark.range(5).select(F.col("id").cast("string").alias("k"))
    name = "user_table_keep_me"
    df.write.mode("overwrite").option("path", str(tmp_path / name)).saveAsTable(name)
    with S.Scratch(spark) as scratch:
        own = scratch.bucketed(df, ["k"], "probe", 2)
        files = scratch.written(df.where("false"), "none")  # without any row
        kept = scratch.written(df, "kept")
        scratch.release(kept)
        paths = [scratch.path(h).removeprefix("file:") for h in (own, files, kept)]
        scratch.drop(files)
        assert [os.path.isdir(p) for p in paths] == [True, False, True]
        assert own.name in {t.name for t in spark.catalog.listTables()}
    assert [os.path.isdir(p) for p in paths] == [False, False, True] and kept.df.count() == 5
    assert own.name not in {t.name for t in spark.catalog.listTables()}
    assert spark.table(name).count() == 5
    spark.sql(f"DROP TABLE {name}")


def test_session_beside_has_settings_of_its_own(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    own = S.session_beside(spark)
    assert own.conf.get(key) == before and own.conf.get("spark.sql.session.timeZone") == "UTC"
    own.conf.set(key, "3")
    assert spark.conf.get(key) == before
    df = S.adopt(own, spark.range(10).repartition(4).groupBy((F.col("id") % 5).alias("k")).count())
    assert df.sparkSession is own and df.count() == 5
