"""Landing folders derived from the driver tables by Spark jobs.

The lab lands raw JSON/CSV files and ingests them; here the files are written
from the given tables (so the work grows with them) into the shared working
area. Every writer clusters rows by the landing partition first, so each
partition directory gets one file per task that holds it, never one per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text timestamps keep microseconds (Spark's JSON/CSV default keeps milliseconds only).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def land(df: DataFrame, path: str, fmt: str = "json", partition_by: list[str] | None = None, **options) -> str:
    """Write ``df`` as landing files, clustered by the partition columns (few files
    per value; a hot value is split over several tasks)."""
    if partition_by:
        from strata.operators.sinks import cluster_for_write
        w = cluster_for_write(df, partition_by).write.partitionBy(*partition_by)
    else:
        w = df.write
    w.mode("overwrite").format(fmt).options(**options).save(path)
    return path


def land_by_day(df: DataFrame, ts_col: str, path: str, fmt: str = "json", day_col: str = "day", **options) -> str:
    """One landing directory per day of ``ts_col`` (``day=YYYY-MM-DD``); a busy day is
    written by several tasks into several files."""
    d = df.withColumn(day_col, F.date_format(F.col(ts_col), "yyyy-MM-dd"))
    return land(d, path, fmt, [day_col], **options)
