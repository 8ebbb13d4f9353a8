"""Session helpers: a configured local session for tests and benches, and the
shared scratch folder used to cut lineage and stage intermediate tables."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings we rely on; a cluster session keeps its own values for anything set.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "shelfwatch") -> SparkSession:
    """A ``local[cores]`` session for tests and benches (never used on a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("SHELFWATCH_DRIVER_MEMORY", "16g")))
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant folder
    and is used as is. Only when nothing is configured (local tests) do we set
    a private folder of our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):  # local-cluster has executors of its own
            # a machine-local folder would not survive the loss of an executor
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="shelfwatch-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for a staged table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/shelfwatch-{name}-{uuid.uuid4().hex[:12]}"


def stage_table(df, name: str = "stage"):
    """Write ``df`` as a parquet table under the shared checkpoint folder and
    return it read back: lineage is cut, values computed once stay fixed for
    every later reader (ids, thresholds), a lost executor re-reads files
    instead of recomputing, and later scans prune columns. One pass over the
    input (a reliable ``checkpoint()`` of an uncached plan computes it twice)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def staged(df, name: str = "stage") -> Iterator:
    """``stage_table`` for the steps of a block: the files go at its end, also
    when it fails, so nothing that reads them may be left for later."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        df.write.mode("errorifexists").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs deleted. Spark does so when the
    driver's garbage collector finds their plans unused, which on a large heap
    is long after the disk is full; a job of many large steps asks for it
    between them. Costs two collections of the driver's heap, whatever the data:
    what the first one finds holds on to the rest until it is cleared."""
    for _ in range(2):
        gc.collect()  # first the Python handles that keep plans alive
        spark._jvm.System.gc()
