"""Batch file sources: typed reads, file metadata, idempotent per-file loads,
daily loads with a content hash, broker payload parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.hashing import content_hash

# Microsecond timestamps in JSON payloads (the default format keeps milliseconds).
JSON_OPTS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

FILE_COL, FILE_MTIME_COL, INGESTED_COL = "_arquivo_origem", "_arquivo_modificado_em", "_ingerido_em"


def read_batch(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str | None = None,
               **options) -> DataFrame:
    """Parquet / CSV / JSON batch read; an explicit schema skips inference (no extra pass)."""
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def with_file_metadata(df: DataFrame, ingested_at=None, mtime: bool = True) -> DataFrame:
    """Audit columns: source file, its modification time, ingestion time.

    ``ingested_at`` makes the stamp injectable (a literal) so reruns are comparable;
    by default it is ``current_timestamp()``.
    """
    stamp = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    cols = [F.col("_metadata.file_path").alias(FILE_COL)]
    if mtime:
        cols.append(F.col("_metadata.file_modification_time").alias(FILE_MTIME_COL))
    cols.append(stamp.alias(INGESTED_COL))
    return df.select("*", *cols)


def full_rebuild(spark: SparkSession, path: str, fmt: str, target: str, **options) -> DataFrame:
    """CTAS over files: the target is recreated from all files on every run."""
    df = spark.read.format(fmt).options(**options).load(path)
    df.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def list_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """(path, length) of the files under a folder, from the file system's listing; no file is opened."""
    kept = {k: v for k, v in options.items() if k in ("pathGlobFilter", "recursiveFileLookup", "modifiedAfter", "modifiedBefore")}
    return spark.read.format("binaryFile").options(**kept).load(path).select("path", "length")


def load_new_files(spark: SparkSession, path: str, fmt: str, target: str, schema=None,
                   merge_schema: bool = True, **options) -> int:
    """COPY INTO: load only files not loaded before; a second run inserts 0 rows and opens no data file.

    The listing is anti-joined with a ledger of loaded paths (``<target>_ledger``); only the new paths, by
    name, are read. The names are noted as pending before the load and join the ledger after it. The load
    itself commits whole or not at all, so after a lost driver the next run sees from the target's
    ``_source_file`` column whether the pending files are in. Returns the number of inserted rows
    (observed on the write). A target that has no ledger yet gets one from that column.
    """
    from strata.session import path_exists
    from strata.operators.sinks import append_batch
    loaded, pending = f"{target.rstrip('/')}_ledger/loaded", f"{target.rstrip('/')}_ledger/pending"
    names = list_files(spark, path, **options).select("path")
    _settle_ledger(spark, target, loaded, pending, merge_schema)
    if path_exists(spark, loaded):
        names = names.join(spark.read.schema("path string").parquet(loaded), "path", "left_anti")
    new = sorted(r.path for r in names.collect())  # names of the files that this run reads
    if not new:
        return 0
    spark.createDataFrame([(n,) for n in new], "path string").coalesce(1).write.mode("overwrite").parquet(pending)
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not any(c in path for c in "*?[{") and fs.getFileStatus(folder).isDirectory():
        r = r.option("basePath", path)
    obs = Observation("copy_into")
    rows = r.load(new).withColumn("_source_file", F.col("_metadata.file_path"))
    append_batch(rows.observe(obs, F.count(F.lit(1)).alias("rows")), target)
    _note_loaded(spark, new, loaded, pending)
    return int(obs.get.get("rows", 0))


def _note_loaded(spark: SparkSession, names: list[str], loaded: str, pending: str) -> None:
    from strata.session import remove_path
    spark.createDataFrame([(n,) for n in names], "path string").coalesce(1).write.mode("append").parquet(loaded)
    remove_path(spark, pending)


def _settle_ledger(spark: SparkSession, target: str, loaded: str, pending: str, merge_schema: bool) -> None:
    """After a lost driver: pending files whose rows are in the target are loaded, the others are not."""
    from strata.session import path_exists, remove_path
    unsettled = path_exists(spark, f"{pending}/_SUCCESS")
    if not path_exists(spark, f"{target}/_SUCCESS") or not (unsettled or not path_exists(spark, loaded)):
        remove_path(spark, pending)
        return
    there = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(target).select("_source_file").distinct()
    jvm = spark.sparkContext._jvm
    seen = {jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r[0])).toString() for r in there.collect()}
    if path_exists(spark, loaded):
        seen -= {r.path for r in spark.read.parquet(loaded).collect()}
    # A file without rows leaves no trace in the target; it is read again, which inserts nothing.
    _note_loaded(spark, sorted(seen), loaded, pending)


def read_target(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(target)


def load_daily(spark: SparkSession, path: str, day: str, source_system: str, hash_cols: list[str],
               partition_col: str = "day") -> DataFrame:
    """One day's partition + metadata + partition columns + a NULL-aware content hash.

    The day filter is on the partition column, so only that directory is listed and read.
    """
    df = spark.read.parquet(path).filter(F.col(partition_col) == F.lit(day))
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"), F.lit(source_system).alias("_source_system"),
                     F.year(F.col(partition_col).cast("date")).alias("_year"),
                     F.month(F.col(partition_col).cast("date")).alias("_month"),
                     content_hash(*[F.col(c) for c in hash_cols]).alias("_content_hash"))


def parse_event_value(df: DataFrame, schema: T.StructType | str, source: str,
                      value_col: str = "value") -> DataFrame:
    """Broker records (binary ``value``): cast to string, from_json, flatten, stamp
    source/topic/partition/offset."""
    parsed = df.select(F.from_json(F.col(value_col).cast("string"), schema, JSON_OPTS).alias("event"),
                       *[F.col(c).alias(f"_{c}") for c in ("topic", "partition", "offset") if c in df.columns])
    return parsed.select("event.*", *[c for c in parsed.columns if c.startswith("_")], F.lit(source).alias("_source"))


def to_broker_records(df: DataFrame, key: Column, topic: str, partitions: int = 8) -> DataFrame:
    """Serialize rows as broker-style records (key, value bytes, topic, partition, offset)."""
    value = F.encode(F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTS), "UTF-8")
    part = F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")
    return df.select(key.cast("string").alias("key"), value.alias("value"), F.lit(topic).alias("topic"),
                     part.alias("partition"), F.monotonically_increasing_id().alias("offset"))


def read_layer(spark: SparkSession, path: str, stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Read a pipeline table (parquet folder) as a batch DataFrame or as a stream
    (the stream takes the table's current schema)."""
    if not stream:
        return spark.read.parquet(path)
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def infer_json_schema(spark: SparkSession, path: str, state: str | None = None) -> T.StructType:
    """Typed schema of nested JSON (structs stay structs, numbers stay numbers) from all records, so no field or
    wider type is missed; the stream then runs with this fixed schema. With ``state``, a folder, what earlier calls
    found is kept there and only new files are read (``schema_state``)."""
    if state is None:
        return spark.read.option("samplingRatio", 1.0).json(path).schema
    from strata.sources.schema_state import observed_schema
    return observed_schema(spark, path, state)
