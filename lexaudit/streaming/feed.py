"""Entries as they come in: scored and filtered row by row, each address once, batches kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lexaudit.session import shared_path


def entries(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def once(stream: DataFrame, key: str, watermark: tuple[str, str] | None = None) -> DataFrame:
    """Each key once. Without a watermark the state grows with the keys ever seen; with one, (time column, delay), a key
    is remembered for the delay."""
    if watermark:
        return stream.withWatermark(*watermark).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def drain(stream: DataFrame, out: str, each: Callable[[DataFrame, int], DataFrame] | None = None) -> DataFrame:
    """Runs a stream over what is there and returns what it wrote; each batch may be changed before it is written.

    Batches are written under their number, so that one written again after a failure replaces itself.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        d = each(batch, number) if each else batch
        d.write.mode("overwrite").parquet(f"{out}/batch={number}")

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", shared_path(spark, "stream")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.option("basePath", out).parquet(f"{out}/*").drop("batch")
