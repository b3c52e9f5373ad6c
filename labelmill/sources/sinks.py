"""Results on disk: sparse matrices in coordinates and the record of a run."""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
from contextlib import contextmanager

from pyspark.sql import DataFrame, Window as W, functions as F

from labelmill import __version__


def write_matrix(layers: DataFrame, folder: str, gene: str = "gx") -> None:
    """layers (layer, barcode, gene, value) as parquet, one folder a layer, with the sorted axes."""
    layers.write.mode("overwrite").partitionBy("layer").parquet(f"{folder}/layers")
    written = layers.sparkSession.read.schema(layers.schema).parquet(f"{folder}/layers")
    for name in ("barcode", gene):
        written.select(name).distinct().orderBy(name).write.mode("overwrite").csv(f"{folder}/{name}")


def with_places(keys: DataFrame, name: str, place: str) -> DataFrame:
    """Sorted distinct keys numbered from 1, by range partitions: counts of partitions are summed,
    so the keys are never in one task."""
    sorted_ = keys.select(name).distinct().repartitionByRange(F.col(name)).sortWithinPartitions(name)
    rows = sorted_.withColumn("part_", F.spark_partition_id()).withColumn("in_", F.monotonically_increasing_id() - (F.spark_partition_id().cast("long") * (1 << 33)))
    sizes = rows.groupBy("part_").agg(F.count(F.lit(1)).alias("n_"))
    before = sizes.withColumn("before_", F.coalesce(F.sum("n_").over(W.partitionBy(F.lit(0)).orderBy("part_").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    return rows.join(F.broadcast(before), "part_").select(name, (F.col("before_") + F.col("in_") + 1).alias(place))  # a row for each partition


def matrix_market(matrix: DataFrame, gene: str = "gx") -> DataFrame:
    """Lines of a MatrixMarket file (cells by genes); the header is line 0, entries follow in order."""
    cells, genes = with_places(matrix.select("barcode"), "barcode", "row_"), with_places(matrix.select(gene), gene, "col_")
    entries = matrix.join(cells, "barcode").join(genes, gene).select("row_", "col_", "value")
    kind = "integer" if matrix.schema["value"].dataType.simpleString() in ("int", "bigint") else "real"
    sizes = cells.agg(F.count(F.lit(1)).alias("r")).crossJoin(genes.agg(F.count(F.lit(1)).alias("c"))).crossJoin(matrix.agg(F.count(F.lit(1)).alias("e")))  # one row each
    head = sizes.select(F.lit(0).cast("long").alias("row_"), F.lit(0).cast("long").alias("col_"), F.concat(F.lit(f"%%MatrixMarket matrix coordinate {kind} general\n"), F.concat_ws(" ", "r", "c", "e")).alias("value"))
    lines = entries.select("row_", "col_", F.concat_ws(" ", "row_", "col_", "value").alias("value"))
    return head.unionByName(lines).orderBy("row_", "col_").select("value")


class RunInfo:
    """When a run began and ended, what it was called with, and how long its steps took."""

    def __init__(self) -> None:
        self.started, self.steps = dt.datetime.now(), {}

    @contextmanager
    def step(self, name: str):
        began = dt.datetime.now()
        yield
        self.steps[name] = (dt.datetime.now() - began).total_seconds()

    def text(self) -> str:
        ended = dt.datetime.now()
        return json.dumps({"version": __version__, "workdir": os.getcwd(), "call": " ".join(sys.argv), "start_time": self.started.isoformat(), "end_time": ended.isoformat(), "elapsed": (ended - self.started).total_seconds(), "steps": self.steps}, indent=2)

    def save(self, folder: str) -> str:
        os.makedirs(folder, exist_ok=True)
        path = os.path.join(folder, f"run_info_{self.started:%Y%m%d_%H%M%S_%f}.json")
        with open(path, "w") as f:
            f.write(self.text())
        return path
