"""Batch sinks: append, overwrite, partitioned writes, quarantine, audit log, certification,
and refresh of only the groups a change touched."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.quality import STATUS_OK, Rule
from strata.sources.landing import TS_FORMAT

# Compression codecs accepted for parquet output.
CODECS = ("snappy", "zstd", "gzip", "none")


def append_batch(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append-only history (columns matched by name on read via mergeSchema)."""
    w = df.write.mode("append").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None, compression: str = "snappy") -> None:
    """Full refresh of a precomputed table."""
    w = df.write.mode("overwrite").format("parquet").option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def cluster_for_write(df: DataFrame, partition_by: list[str], n: int | None = None) -> DataFrame:
    """Range-partition by the partition columns plus a row hash.

    Small partition values share a task (few files), while a hot value (even a
    third of the rows) is split across several tasks by the hash tiebreak
    instead of landing in one task as with ``repartition(*partition_by)``.
    """
    tb = F.xxhash64(*[F.col(c) for c in df.columns])
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (df.withColumn("__tb", tb).repartitionByRange(n, *[F.col(c) for c in partition_by], F.col("__tb"))
              .drop("__tb"))


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], compression: str = "zstd",
                      max_records_per_file: int | None = None, mode: str = "overwrite",
                      dynamic: bool = False) -> None:
    """Partitioned parquet with rows clustered by the partition columns first, so each
    task writes few files (no small-file explosion) and hot values are split."""
    if compression not in CODECS:
        raise ValueError(f"unknown codec {compression}")
    w = (cluster_for_write(df, partition_by).write.mode(mode).format("parquet")
         .option("compression", compression).partitionBy(*partition_by))
    if dynamic:  # replace only the partitions present in df
        w = w.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


def refresh_groups(target: DataFrame, changes: DataFrame, group_cols: list[str], builder) -> DataFrame:
    """Materialized-view refresh of touched groups only.

    ``builder(df)`` maps source rows to aggregated rows keyed by ``group_cols``.
    Only groups that appear in ``changes`` are recomputed (from ``changes``,
    which must hold *all* source rows of those groups); all other target rows
    are kept. Written with dynamic partition overwrite when the target is
    partitioned by the group columns, only the touched partitions are rewritten.
    """
    fresh = builder(changes)
    # A group whose rows all fail a rule is touched too, though it has no fresh row.
    seen = changes if set(group_cols) <= set(changes.columns) else fresh
    touched = seen.select(*group_cols).distinct()
    kept = target.join(touched, on=group_cols, how="left_anti")
    return kept.unionByName(fresh)


def refresh_partitions(spark, path: str, changes: DataFrame, group_cols: list[str], builder, touched: DataFrame | None = None) -> None:
    """Refresh a gold table partitioned by ``group_cols`` in place.

    ``touched`` names the groups that the raw change touched (default: those in ``changes``), and ``changes``
    holds all source rows that count for them. A group with fresh rows gets these (dynamic overwrite), one
    without any loses its files, and every other partition keeps its own. Repeating the call after a lost
    driver ends the same; the groups' names alone are shuffled.
    """
    from strata.operators.stored import _each, _fs
    from strata.session import path_exists
    fresh = builder(changes)
    write_partitioned(fresh, path, group_cols, compression="snappy", dynamic=True)
    if not path_exists(spark, path):
        return
    seen = (changes if touched is None else touched).select(*group_cols).distinct()
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"f.{c}")) for c in group_cols]
    empty = seen.alias("t").join(fresh.select(*group_cols).distinct().alias("f"), same, "left_anti")
    try:
        table = spark.read.parquet(path)
    except AnalysisException:  # no partition has a row
        return
    kinds = {c: table.schema[c].dataType for c in group_cols}
    empty = empty.select(*[F.col(c).cast(kinds[c]).alias(c) for c in group_cols])
    held = table.select(*group_cols, F.col("_metadata.file_path").alias("__file"))
    same = [F.col(f"h.{c}").eqNullSafe(F.col(f"e.{c}")) for c in group_cols]
    files = held.alias("h").join(empty.alias("e"), same, "left_semi").select("__file").distinct().collect()
    jvm, fs = spark.sparkContext._jvm, _fs(spark, path)
    _each([r["__file"] for r in files], lambda f: fs.delete(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)), False))


def quarantine(df: DataFrame, rules: list[Rule], source: str, as_of: datetime,
               record_cols: list[str] | None = None, partition_cols: list[str] = ()) -> DataFrame:
    """Rows failing any rule -> (quarantined_at, reason, detail, record JSON, source, partition cols)."""
    fails = [F.when(~r.passed(), F.lit(r.name)) for r in rules]
    details = [F.when(~r.passed(), F.lit(f"{r.name}: {r.condition}")) for r in rules]
    rec = F.to_json(F.struct(*[F.col(c) for c in (record_cols or df.columns)]),
                    {"ignoreNullFields": "false", "timestampNTZFormat": TS_FORMAT})
    q = df.select("*", F.concat_ws(",", *fails).alias("reason"), F.concat_ws("; ", *details).alias("detail"))
    q = q.filter(F.col("reason") != "")
    return q.select(F.lit(as_of).cast("timestamp_ntz").alias("quarantined_at"), "reason", "detail",
                    rec.alias("record"), F.lit(source).alias("source"), *partition_cols)


def ingestion_log_rows(df: DataFrame, table_col: str, date_col: str, load_col: str, status: Column,
                       logged_at: Column) -> DataFrame:
    """One audit row per load (table, date, load id): row count, status, time."""
    return (df.groupBy(F.col(table_col).alias("table_name"), F.col(date_col).alias("load_date"), F.col(load_col).alias("load_id"))
              .agg(F.count(F.lit(1)).alias("row_count"), status.alias("status"), logged_at.alias("logged_at")))


class NotCertified(Exception):
    pass


def certify(spark, tables: list[str], status: str, rate: float, as_of: datetime) -> DataFrame:
    """Certification rows for gold tables when the gate says OK; otherwise raise (gold stays uncertified)."""
    if status != STATUS_OK:
        raise NotCertified(f"quality outside the limit (rate={rate:.4%}); gold not certified")
    rows = [(t, status, float(rate), as_of) for t in tables]
    return spark.createDataFrame(rows, "table_name string, status string, rate double, certified_at timestamp_ntz")
