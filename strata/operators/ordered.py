"""Order-dependent operators that stay balanced when one key is huge.

A plain ``lead``/``last`` window partitioned by key sends every row of a key
to one task; if one key holds a third of the data, that task sorts a third
of the data. Here the key's rows are cut into order-preserving chunks
(``chunk`` = a coarse bucket of the ordering column, e.g. one day of event
time). The window runs per (key, chunk); only the chunk boundaries need
information from neighbouring chunks, and that comes from a per-(key, chunk)
summary (one row per chunk, tiny) with its own window by key, joined back on
(key, chunk). The result is exact for any chunk width.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.util import as_col, names

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def interval_seconds(width: str) -> int:
    m = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day|week)s?\s*", width)
    if not m:
        raise ValueError(f"unsupported chunk width {width!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def time_chunk(c, width: str = "1 day") -> Column:
    """Order-preserving bucket of a timestamp/date column."""
    secs = interval_seconds(width)
    micros = F.unix_micros(as_col(c).cast("timestamp"))
    return F.floor(micros / F.lit(secs * 1_000_000)).cast("long")


def auto_chunk_width(df: DataFrame, keys, ts: str, target_rows: int = 2_000_000) -> str:
    """Chunk width that keeps every (key, chunk) at or below ``target_rows``.

    One aggregate (partial aggregation first) measures the densest key-day and
    key-hour; only two numbers reach the driver. Days are used when even the
    densest key-day fits, hours when the densest key-hour fits, else seconds.
    """
    keys = names(keys)
    hourly = df.groupBy(*keys, time_chunk(F.col(ts), "1 hour").alias("__h")).agg(F.count(F.lit(1)).alias("n"))
    per_day = (hourly.groupBy(*keys, F.floor(F.col("__h") / 24).alias("__d"))
                     .agg(F.sum("n").alias("n_day"), F.max("n").alias("n_hour")))
    row = per_day.agg(F.max("n_day").alias("d"), F.max("n_hour").alias("h")).collect()[0]
    max_day, max_hour = row["d"] or 0, row["h"] or 0
    if max_day <= target_rows:
        return "1 day"
    if max_hour <= target_rows:
        return "1 hour"
    return f"{max(1, (3600 * target_rows) // max_hour)} seconds"


def numeric_chunk(c, width: float) -> Column:
    return F.floor(as_col(c) / F.lit(width)).cast("long")


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint (files under ``spark.checkpoint.dir``).

    Used where one input feeds two branches (detail window and chunk summary):
    without it Spark recomputes the whole upstream (scans and shuffles) per branch.
    """
    from strata.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def next_in_key(df: DataFrame, keys, order: list[str], value: str, out: str, chunk: Column,
                checkpoint: bool = False) -> DataFrame:
    """``out`` = ``value`` of the next row of the same key (ascending ``order``), like ``lead``.

    ``chunk`` must be non-decreasing in ``order`` within a key. With ``checkpoint``
    the input is materialized once for the two branches.
    """
    keys = names(keys)
    d = df.withColumn("__chunk", chunk)
    if checkpoint:
        d = materialize(d)
    w = Window.partitionBy(*keys, "__chunk").orderBy(*[F.col(o).asc_nulls_first() for o in order])
    d = (d.withColumn(out, F.lead(value).over(w))
          .withColumn("__last_in_chunk", F.lead(F.lit(1)).over(w).isNull()))
    first = (d.groupBy(*keys, "__chunk")
              .agg(F.min_by(F.col(value), F.struct(*[F.col(o) for o in order])).alias("__first")))
    w2 = Window.partitionBy(*keys).orderBy("__chunk")
    bridge = first.select(*keys, "__chunk", F.lead("__first").over(w2).alias("__next_first"))
    joined = d.join(bridge, on=[*keys, "__chunk"], how="left")
    return (joined.withColumn(out, F.when(F.col("__last_in_chunk"), F.col("__next_first")).otherwise(F.col(out)))
                  .drop("__chunk", "__last_in_chunk", "__next_first"))


def last_before_in_key(events: DataFrame, keys, ts: str, marker: str, payload: str, out: str,
                       chunk: Column, checkpoint: bool = False) -> DataFrame:
    """For rows where ``marker`` is false, ``out`` = last ``payload`` of a marker row
    of the same key at or before ``ts`` (marker rows sort first on equal ``ts``).

    ``payload`` must be non-NULL on marker rows and NULL elsewhere. Returns only
    the non-marker rows.
    """
    keys = names(keys)
    d = events.withColumn("__chunk", chunk)
    if checkpoint:
        d = materialize(d)
    w = (Window.partitionBy(*keys, "__chunk").orderBy(F.col(ts).asc(), F.col(marker).desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn(out, F.last(payload, ignorenulls=True).over(w))
    # Per (key, chunk): the last marker payload of the chunk, and the chunks that hold
    # unmarked rows. One small window by key carries the latest earlier payload to
    # every chunk; unmarked rows sort before marker summaries of the same chunk so a
    # chunk never borrows its own (possibly later) markers.
    summ = (d.filter(F.col(marker)).groupBy(*keys, "__chunk")
             .agg(F.max_by(F.col(payload), F.col(ts)).alias("__chunk_last"))
             .withColumn("__is_m", F.lit(True)))
    wanted = (d.filter(~F.col(marker)).select(*keys, "__chunk").distinct()
               .withColumn("__chunk_last", F.lit(None).cast(summ.schema["__chunk_last"].dataType))
               .withColumn("__is_m", F.lit(False)))
    w2 = (Window.partitionBy(*keys).orderBy(F.col("__chunk").asc(), F.col("__is_m").asc())
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carry = (wanted.unionByName(summ)
             .withColumn("__carry", F.last("__chunk_last", ignorenulls=True).over(w2))
             .filter(~F.col("__is_m")).select(*keys, "__chunk", "__carry"))
    res = d.filter(~F.col(marker)).join(carry, on=[*keys, "__chunk"], how="left")
    return (res.withColumn(out, F.coalesce(F.col(out), F.col("__carry")))
               .drop("__chunk", "__carry"))
