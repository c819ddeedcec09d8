"""Structured Streaming helpers: file sources, run-on-new-data, idempotent sinks.

Every job runs with `availableNow` over a checkpoint: it processes what is new,
then stops, and a restart continues where the last run ended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WATERMARK = "1 hour"


def file_stream(spark: SparkSession, path: str, schema: str | T.StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # as a glob, the path may name one file as well as a folder of part files
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def run_to_files(df: DataFrame, out: str, checkpoint: str):
    """Append mode into a Parquet folder; returns the finished query."""
    q = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    q.awaitTermination()
    return q


def run_batches(df: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str):
    q = df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def run_refreshing(df: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, lag: str = "1 minute"):
    """The same job kept within a target lag; returns the running query."""
    return df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(processingTime=lag).start()


def batch_folder(out: str) -> Callable[[DataFrame, int], None]:
    """Sink that owns one folder per batch: a replayed batch overwrites itself."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return apply


def event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP; the session zone is UTC, so the clock reading stays."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def clock(c, fmt: str = "yyyy-MM-dd HH:mm:ss"):
    return F.date_format(c, fmt)


def first_arrivals(out: str, key: str, keep_batches: int | None = None) -> Callable[[DataFrame, int], None]:
    """Sink that keeps the first arrival of each key, whenever it comes and whatever its event time.

    The keys of every batch are stored beside its rows and joined with the next ones, so a late first arrival is
    kept and a later copy dropped, across runs and restarts; a replayed batch overwrites itself. With
    `keep_batches`, keys older than so many batches expire. Within a batch one row of a key stays. Null keys
    can't be told apart and all stay."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        one = batch.where(F.col(key).isNotNull()).dropDuplicates([key])
        known = f"{out}/keys"
        if batch_id > 0:
            seen = spark.read.schema(f"{key} {batch.schema[key].dataType.simpleString()}, batch_id INT").parquet(known)
            seen = seen.where(F.col("batch_id") < batch_id)
            seen = seen if keep_batches is None else seen.where(F.col("batch_id") >= batch_id - keep_batches)
            one = one.join(seen.select(key), key, "left_anti")
        fresh = one.select(*batch.columns).unionByName(batch.where(F.col(key).isNull()))
        fresh.write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")
        stored = spark.read.schema(batch.schema).parquet(f"{out}/rows/batch_id={batch_id}")
        stored.where(F.col(key).isNotNull()).select(key).write.mode("overwrite").parquet(f"{known}/batch_id={batch_id}")

    return apply
