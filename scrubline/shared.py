"""The folder that driver and executors share, and what is put there."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, which the cluster names.

    Where it is unset a local session gets a temporary folder, since there all tasks share this machine's disk; any other
    session is refused, because executors would not see a local folder of the driver.
    """
    context = spark.sparkContext
    directory = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if directory is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        directory = "file://" + tempfile.mkdtemp(prefix="scrubline-")
        context.setCheckpointDir(directory)
    return directory


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, directory: str) -> None:
    """Deletes a folder that was made with ``fresh_dir``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the shared folder, without the lineage before them.

    Spark removes the files when the DataFrame is gone and ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df`` cut off, and marked for broadcast only if counting shows that it has at most ``rows`` (narrow) rows."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= rows else df
