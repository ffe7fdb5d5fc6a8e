"""Session helpers: one place for the settings every job relies on."""
from __future__ import annotations

import gc
import os
import uuid

from pyspark.sql import SparkSession

# Settings that change results, pinned for every job (D3, D11, §1.3 item 9).
RESULT_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.json.enablePartialResults": "true",
}

# Settings that only change speed; applied where the session allows it.
SPEED_CONFS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}

# Removes the shuffle files of a query as soon as it ends; on for ``materialize`` only.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build(master: str | None = None, app: str = "dockline", shuffle_partitions: int | None = None,
          extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session. On a cluster, ``master`` stays None and
    the launcher decides; tests and the bench pass ``local[N]``."""
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**RESULT_CONFS, **SPEED_CONFS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the result-relevant settings on an existing session."""
    for k, v in RESULT_CONFS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, v in SPEED_CONFS.items():
        try:
            if spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        except Exception:  # pragma: no cover - read-only conf on some deployments
            pass
    _ensure_checkpoint_dir(spark)
    return spark


def _ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only when it is unset (tests,
    local runs) set one under a fresh scratch folder."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = os.path.join(os.environ.get("DOCKLINE_SCRATCH", "/tmp"), f"dockline-ckpt-{uuid.uuid4().hex[:8]}")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory, for tables a job
    writes to cut lineage or to hand data to a later step."""
    base = _ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint
    folder and reading it back: one job, survives executor loss, and the
    read is vectorised and prunable. Nothing reads the write's shuffle files
    again, so they go with it and not when the driver next collects garbage."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)       # no job to find the schema


def discard(*tables) -> None:
    """Remove the folders of tables that ``materialize`` returned. Only for tables that no later job reads: those a
    caller may still have to compute from must stay."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def tidy(spark: SparkSession) -> None:
    """Free what a long job left in the driver, whose memory would otherwise grow from one to the next: Python
    objects that refer to each other, then what they held in the JVM."""
    gc.collect()
    spark._jvm.java.lang.System.gc()
