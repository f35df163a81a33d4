"""Incremental file ingestion with Structured Streaming.

A landing folder is read as a file stream with a fixed schema; each run
drains everything new with ``trigger(availableNow=True)`` and stops, and the
checkpoint remembers which files were done, so a rerun reads nothing. The
sink is parquet (append) under the shared checkpoint area.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.sources.files import with_file_metadata


def read_landing_stream(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str,
                        max_files_per_trigger: int | None = None, ingested_at=None, mtime: bool = True,
                        **options) -> DataFrame:
    """Streaming scan of a landing folder: all columns + audit columns."""
    r = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_file_metadata(r.load(path), ingested_at=ingested_at, mtime=mtime)


def append_stream(df: DataFrame, target: str, checkpoint: str, partition_by: list[str] | None = None,
                  available_now: bool = True, fmt: str = "parquet"):
    """Append a stream to a table with a checkpoint; availableNow drains and stops."""
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start(target)


def ingest_available_now(spark: SparkSession, landing: str, fmt: str, schema, target: str, checkpoint: str,
                         partition_by: list[str] | None = None, transform=None, **options) -> None:
    """One triggered run: read new landing files, optional transform, append, stop."""
    src = read_landing_stream(spark, landing, fmt, schema, **options)
    if transform is not None:
        src = transform(src)
    q = append_stream(src, target, checkpoint, partition_by)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def run_foreach_batch(df: DataFrame, fn, checkpoint: str, available_now: bool = True):
    """Drive ``fn(batch_df, batch_id)`` over a stream (exactly-once per batch id when fn is idempotent)."""
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q
