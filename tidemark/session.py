"""Session settings and the shared folder used for checkpoints and work tables."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
# estimated input size up to which costly per-row work is spread by a shuffle
SMALL_BYTES = 256 * 1024 * 1024
# long texts: batches sent to Python are bounded by size, not by ten thousand rows
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 1024 * 1024)}
# applications that have the package already
_SHIPPED: set[str] = set()


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` overrides any setting.

    Shuffle partitions are left to the cluster; adaptive execution coalesces them.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **BATCHES,
        # keys never reach a plan, but a caller's own literal might
        "spark.sql.redaction.string.regex": "(?i)(secret|passphrase|hexkey)[^\\s,)]*",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once, so UDFs import it wherever they run; batches for Python are bounded."""
    context = spark.sparkContext
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    if context.applicationId not in _SHIPPED:
        parent = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark")
        context.addPyFile(shutil.make_archive(archive, "zip", parent, "tidemark"))
        _SHIPPED.add(context.applicationId)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a folder below its warehouse.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    spark.sparkContext.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tidemark")
    return spark.sparkContext.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for one written table."""
    return os.path.join(shared_root(spark), f"tidemark-{name}-{uuid.uuid4().hex}")


def spread_small(df: DataFrame) -> DataFrame:
    """Give a small input of costly per-row work to all cores.

    A file below one scan partition would run in one task. Larger inputs already have a
    task per 128 MB, and stay as they are read.
    """
    if df.isStreaming:
        return df
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(size)) > SMALL_BYTES:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder, so a lost executor does not replay the plan."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)
