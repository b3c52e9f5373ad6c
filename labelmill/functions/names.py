"""Column names that cannot clash with those of a caller's table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def free_name(wanted: str, taken: Iterable[str]) -> str:
    """`wanted`, with as many underscores appended as it takes to differ from every taken name.

    Names are compared without case, as Spark resolves columns.
    """
    used = {t.lower() for t in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def row_hash(df: DataFrame) -> Column:
    """A hash of a row and its partition, the same whenever a task is run again.

    Maps have no hash and are left out; rows that differ in nothing else share theirs within a
    partition.
    """
    return F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and t != "variant"], F.spark_partition_id())
