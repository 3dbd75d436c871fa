"""Where intermediate tables live.

Iterative operators must shorten their lineage with storage that survives the
loss of an executor, so everything goes to the folder the cluster names in
``spark.checkpoint.dir``.  A machine-local folder is used only when that
setting is absent *and* the session runs in local mode (unit tests).
"""

from __future__ import annotations

import atexit
import pathlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables of this session."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    fallback = tempfile.mkdtemp(prefix="pricepanel-")
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


_SCRATCH: list[tuple[SparkSession, str]] = []


def release() -> None:
    """Delete the scratch tables of this process; their results must have been consumed."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        try:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        except Exception:  # the session is gone; at exit there is nobody left to tell
            return


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used; deleted when the process ends."""
    if not _SCRATCH:
        atexit.unregister(release)
        atexit.register(release)
    path = f"{shared_dir(spark).rstrip('/')}/pricepanel/{label}-{uuid.uuid4().hex}"
    _SCRATCH.append((spark, path))
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` out reliably and continue from the written copy."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of all executors (once per application)."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = pathlib.Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="pricepanel-code-")
    archive = shutil.make_archive(
        f"{folder}/pricepanel", "zip", root_dir=package.parent, base_dir=package.name
    )
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hash-partition by ``keys`` into ``spark.sql.shuffle.partitions`` tasks.

    Cross products are small in bytes but expensive to solve, so partitions
    sized by bytes would merge the work of many focals into one task.  An
    explicit partition count is left alone by adaptive coalescing.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)
