"""Where intermediate tables go.

Some operators need a result to be computed once and read several times.  They keep
it in the folder the cluster shares (``spark.checkpoint.dir``), so that a lost executor
costs a re-read, never a recomputation that could differ.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach; a temporary one only on a local master."""
    global _local_folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="tally-")
    return _local_folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, grouped by application so that it is easy to clear."""
    return f"{shared_dir(spark)}/tally/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, partition by partition in its order."""
    context = df.sparkSession.sparkContext
    folder = shared_dir(df.sparkSession)  # an error on a cluster that names none
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()


def clear(spark: SparkSession) -> None:
    """Remove what this application has written with :func:`fresh_path`; results read from it go too."""
    folder = f"{shared_dir(spark)}/tally/{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
