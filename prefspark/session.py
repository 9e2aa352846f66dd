"""Session helpers: local sessions for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "prefspark") -> SparkSession:
    """A local session configured the way the tests and the bench run."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Tokenizing stages explode a few KB of shuffled text into many rows; a small minimum
        # keeps them parallel (large shuffles are still sized by the 64 MB advisory size).
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # reliable checkpoints are released once their DataFrames are garbage-collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", os.environ.get("PREFSPARK_CLEAN_CHECKPOINTS", "true"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PREFSPARK_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, wiring it into the SparkContext.

    The folder the cluster names in ``spark.checkpoint.dir`` wins. Only when the
    session names none *and* runs in local mode (tests) is a scratch folder created.
    On a cluster without the setting this raises instead of guessing a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="prefspark-ckpt-", dir="/tmp"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/DBFS) "
        "so iterative operators can cut lineage reliably"
    )


def materialize(df):
    """Cut lineage with a reliable checkpoint (never a local one): the result survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Inside, what a query shuffled is removed from the executors' disks when it ends, not when the driver's garbage is collected.

    For writes of intermediate tables: running the same query again would shuffle anew.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


class Scratch:
    """Intermediate tables of an iterative operator, under the shared checkpoint folder, removed when the block ends.

    A table that is written and read back is a plain scan: it has no lineage, and unlike a checkpoint it brings no
    constraints of the plan behind it, which the optimizer multiplies from round to round. The operator's result has
    to be materialized inside the block.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"
        self.tables = 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def written(self, df, by: str | None = None):
        """``df`` written and read back; with ``by`` in a folder for each value of that column, so that a filter by it reads no others."""
        self.tables += 1
        path = f"{self.path}/{self.tables}"
        (df.repartition(by).write.partitionBy(by) if by else df.write).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def spread_scan(df):
    """Input-parallelism guard for a *raw file scan* about to be exploded into many rows.

    Only when the scan yields fewer splits than the cluster has cores (a few large row
    groups) is it spread round-robin; a real input with thousands of splits is returned
    untouched, so the guard costs nothing at scale. Call it on scans only: asking an
    adaptive (shuffled) plan for its partition count would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)
