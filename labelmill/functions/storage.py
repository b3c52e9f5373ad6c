"""Reading test tables and cutting lineage in the folder that the cluster names."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _delete_at_end(spark: SparkSession, path: str) -> None:
    """Have a folder deleted when the application ends."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)


def use_checkpoints(spark: SparkSession) -> None:
    """Make checkpoint() usable.

    The cluster's shared folder (spark.checkpoint.dir) is taken when it is set.  A folder of this
    machine is made only if the executors run in this very process, as in tests; anywhere else a
    missing setting is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="labelmill-checkpoint-")
        _delete_at_end(spark, named)
    context.setCheckpointDir(named)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of df, computed now and read from reliable storage afterwards."""
    use_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the place that checkpoints go to, which all executors share; it is deleted
    when the application ends."""
    use_checkpoints(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    _delete_at_end(spark, path)
    return path
