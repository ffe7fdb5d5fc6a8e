"""Session helpers."""
import glob
import time

from pyspark.sql import functions as F

from dockline import session as SESSION


def _shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d.getPath()}/**/shuffle_*", recursive=True)}


def test_materialize_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    df = spark.range(10_000).groupBy((F.col("id") % 1_000).alias("k")).agg(F.count("*").alias("n")).sort("n", "k")
    got = SESSION.materialize(df, "test-shuffle")
    end = time.time() + 10
    while _shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert got.count() == df.count() == 1_000 and got.groupBy("n").count().collect() == [(10, 1_000)]
    assert spark.conf.get(SESSION.SHUFFLE_CLEANUP, None) is None
