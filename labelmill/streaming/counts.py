"""Running totals of counts that arrive piece by piece, with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from labelmill.operators.filters import is_labeled


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, files_at_once: int = 16) -> DataFrame:
    """New parquet files of a folder, a bounded number in each batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def unique_rows(stream: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """Rows that were not delivered before within the time that late rows are waited for."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def running_matrix(stream: DataFrame, conversions: list[str]) -> DataFrame:
    """Labeled and unlabeled reads per cell and gene so far (output mode complete or update)."""
    labeled = is_labeled(conversions)
    return stream.groupBy("barcode", "gx").agg(F.count_if(~labeled).alias("unlabeled"), F.count_if(labeled).alias("labeled"))


def windowed_counts(stream: DataFrame, time: str, width: str, late: str, by: list[str]) -> DataFrame:
    """Rows per time window and key; a window is final once no late rows are waited for (append)."""
    counted = stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def run_to_table(result: DataFrame, folder: str, checkpoint: str) -> None:
    """Process what has arrived and keep the whole result as parquet in `folder` (mode complete).

    Each batch writes the table anew, so a batch that is run again after a failure does no harm.
    """

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(folder)

    result.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_once(result: DataFrame, name: str, mode: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived, into a table in memory; for tests and small results."""
    query = result.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
