"""Cutting the lineage of iterative jobs on storage every executor can reach."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a local session that
    has none gets a temporary one; a cluster session without one is an error, because
    machine-local files would vanish with their executor.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="coterie-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return context.getCheckpointDir()


def cut(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and return the table.

    Later steps read it from shared storage, so a lost executor costs only its own tasks. Unlike
    ``checkpoint()``, the table is columnar, is planned by its real size, and carries none of
    the constraints that Catalyst otherwise piles up over the steps of a loop. ``compression`` is
    the session's unless given.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path on the shared storage for a file-format round trip."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
