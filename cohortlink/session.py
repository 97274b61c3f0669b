"""Session construction and the shared scratch folder.

On a cluster the checkpoint folder is named by ``spark.checkpoint.dir`` and is
shared by all executors; it is read from the session.  Only when it is unset
(local runs, tests) is a fresh folder under /tmp set.
"""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "cohortlink",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE, skew-join splitting and UTC time."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = "8g"   # local mode: the driver JVM is the executor
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="cohortlink-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_RUN_ROOT: contextvars.ContextVar[str | None] = contextvars.ContextVar("cohortlink_run_root", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder (below the
    current run's folder while one is open, see ``run_scratch``)."""
    base = _RUN_ROOT.get() or os.path.join(ensure_checkpoint_dir(spark), "scratch")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


@contextlib.contextmanager
def run_scratch(spark: SparkSession, name: str = "release"):
    """Keep every stage table written inside the block under one folder, so
    the job can drop them together once its outputs are written."""
    root = scratch_path(spark, name)
    token = _RUN_ROOT.set(root)
    try:
        yield root
    finally:
        _RUN_ROOT.reset(token)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a run's scratch folder (any Hadoop file system)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    and continue from it.

    Survives executor loss (the data lives in shared storage, not in executor
    memory or local disk) and cuts the lineage like ``checkpoint()``; being
    columnar, later readers of a wide stage table read only the columns they
    use, and the planner sees the table's real size.  Used for the stage
    tables that several outputs read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
