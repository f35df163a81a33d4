"""Layout and retention jobs on parquet tables: compaction, clustering for data
skipping, retention purge, bucketed tables for shuffle-free joins."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import input_bytes

# Retention per layer in days (None = keep forever).
RETENTION_DAYS = {"bronze": 90, "silver": 730, "gold": None}
# Target file size per layer in MB.
TARGET_FILE_MB = {"bronze": 128, "silver": 64, "gold": 32}


def table_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the table's data files, from the file metadata column (no listing on the driver)."""
    files = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size").distinct()
    return int(files.agg(F.sum("file_size")).collect()[0][0] or 0)


def file_count(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(path).select("_metadata.file_path").distinct().count()


def compact(spark: SparkSession, src: str, dst: str, target_mb: int = 128, partition_by: list[str] | None = None) -> str:
    """Rewrite a table of many small files into files of about ``target_mb``.

    The number of output files comes from the real byte size; without partition
    columns ``coalesce`` merges input splits without a shuffle, with them the rows
    are clustered per partition value first.
    """
    n = max(1, math.ceil(table_bytes(spark, src) / (target_mb * 1024 * 1024)))
    df = spark.read.parquet(src)
    if partition_by:
        from strata.operators.sinks import cluster_for_write
        out = cluster_for_write(df, partition_by, n).write.partitionBy(*partition_by)
    else:
        out = df.coalesce(n).write
    out.mode("overwrite").parquet(dst)
    return dst


def cluster(df: DataFrame, cols: list[str], n: int | None = None) -> DataFrame:
    """Range-partition and sort by ``cols`` so each file covers a narrow range of them
    (tight parquet min/max statistics -> row groups skipped on filters). A row
    hash is the last range key, so one very frequent value still splits over
    several files instead of one task."""
    n = n or df.sparkSession.sparkContext.defaultParallelism
    tb = F.xxhash64(*[F.col(c) for c in df.columns])
    return (df.withColumn("__tb", tb).repartitionByRange(n, *[F.col(c) for c in cols], F.col("__tb"))
              .sortWithinPartitions(*cols).drop("__tb"))


def _ordinal(df: DataFrame, name: str) -> Column:
    """The column as a double or long in its own order; of a string or binary its first seven bytes."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long")
    raise ValueError(f"can't cluster by {name}: {kind.simpleString()}")


def _rank(value: Column, bounds: list) -> Column:
    """How many of the sorted ``bounds`` are at most ``value`` (binary search as nested CASE)."""
    def step(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < F.lit(bounds[mid]), step(lo, mid)).otherwise(step(mid + 1, hi))
    return step(0, len(bounds))


def interleaved_rank(df: DataFrame, cols: list[str], bits: int = 6) -> Column:
    """Place on a space-filling (Z-order) curve: range ranks of ``cols``, their bits interleaved.

    Ranks come from approximate quantiles (one aggregate; at most 2^bits numbers a column reach the driver), so skewed
    columns are cut into ranges of equal rows. Nulls have rank 0.
    """
    if not cols or bits * len(cols) > 62:
        raise ValueError("need 1 column or more, and at most 62 bits in all")
    steps = [i / 2 ** bits for i in range(1, 2 ** bits)]
    values = [_ordinal(df, c) for c in cols]
    cuts = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values)]).agg(
        *[F.percentile_approx(f"v{i}", steps, 100 * 2 ** bits).alias(f"v{i}") for i in range(len(cols))]).first()
    z = F.lit(0).cast("long")
    for j, v in enumerate(values):
        rank = F.when(v.isNull(), F.lit(0)).otherwise(_rank(v, sorted(set(cuts[j] or [])))).cast("long")
        for b in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("long")), b * len(cols) + j))
    return z


def cluster_interleaved(df: DataFrame, cols: list[str], files: int, bits: int = 6) -> DataFrame:
    """Cluster by several columns at once: each of the ``files`` ranges of the curve is narrow in every one of ``cols``,
    so a filter on any of them skips most files. A row hash splits places that hold many equal rows."""
    tb = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return (df.withColumns({"__z": interleaved_rank(df, cols, bits), "__tb": tb}).repartitionByRange(files, "__z", "__tb")
              .sortWithinPartitions("__z").drop("__z", "__tb"))


def files_for(spark: SparkSession, paths: list[str], target_mb: int = 128) -> int:
    """Number of files of about ``target_mb`` for the bytes under ``paths`` (file-system metadata only)."""
    return max(1, math.ceil(input_bytes(spark, paths) / (target_mb * 1024 * 1024)))


def purge(df: DataFrame, date_col: str, days: int | None, as_of: date) -> DataFrame:
    """Rows still inside the retention window (``days`` None keeps everything)."""
    if days is None:
        return df
    cutoff = F.date_sub(F.lit(as_of), days)
    return df.filter(F.col(date_col).cast("date") >= cutoff)


def purge_layer(df: DataFrame, layer: str, date_col: str, as_of: date) -> DataFrame:
    return purge(df, date_col, RETENTION_DAYS[layer], as_of)


def purge_partitions(spark: SparkSession, path: str, partition_col: str, keep_from: str) -> list[str]:
    """Delete whole ``partition_col=value`` directories older than ``keep_from``
    (partition-aligned retention: no data file is rewritten)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    removed = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(partition_col + "="):
            value = name.split("=", 1)[1]
            if value < keep_from:
                fs.delete(st.getPath(), True)
                removed.append(value)
    return removed


def save_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str) -> None:
    """Bucketed, sorted table: joins and aggregations on ``key`` with tables of the same
    bucket count read co-partitioned data and skip the shuffle. Each bucket is one file,
    as the rows are first dealt to as many tasks by the same hash."""
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(table))


def analyze(spark: SparkSession, table: str, columns: list[str] | None = None) -> None:
    """Column statistics for the cost-based optimizer (join reordering, broadcast sizing)."""
    cols = f" FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{cols}")
