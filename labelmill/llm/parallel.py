"""Partitions for work that costs far more than a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """A scan in enough partitions to keep all cores busy.

    Only small tables, or files that cannot be split, have fewer partitions than there are cores;
    all others stay as they are read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df
