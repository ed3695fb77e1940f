"""Session helpers: recommended settings and the shared checkpoint folder."""

from __future__ import annotations

import gc
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators expect. Cluster sizing (executors,
    shuffle partitions, split size) stays with whoever submits the job."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its executor, so we refuse.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="deskloom-checkpoint-"))
    return sc.getCheckpointDir()


_own = threading.local()  # scopes of this thread: a stream's batches run in one of their own


def _scopes() -> list[list[str]]:
    if not hasattr(_own, "scopes"):
        _own.scopes = []
    return _own.scopes


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that ``cut_lineage`` writes within it are deleted at its end. Write the result that
    depends on them before."""
    _scopes().append([])
    try:
        yield
    finally:
        for path in _scopes().pop():
            delete_folder(spark, path)


def _folder(spark: SparkSession, path: str):
    """The path and its file system, as Spark's own readers and writers see them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def child_folders(spark: SparkSession, path: str, holding: str | None = None) -> list[str]:
    """Names of the folders in ``path``, or of those that hold a file named ``holding``."""
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    held = [c.getPath() for c in files.listStatus(folder) if c.isDirectory()]
    marker = spark._jvm.org.apache.hadoop.fs.Path
    return [p.getName() for p in held if holding is None or files.exists(marker(p, holding))]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a parquet table under the shared checkpoint folder and read it back.

    Unlike ``DataFrame.checkpoint`` the plan runs once, the result is columnar, and its size
    is known to later joins. It outlives any executor; a ``scratch_scope`` or the folder's owner
    clears it.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if _scopes():
        _scopes()[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let the files of shuffles go that no plan needs any more. Spark deletes them when the driver's
    garbage is collected; a driver with memory to spare may not do that before the job ends."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
