"""Event-time windows (batch and streaming), speed/batch merge, streaming dedup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tumbling(df: DataFrame, ts_col: str, width: str, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Tumbling event-time window aggregate; the window becomes window_start / window_end."""
    g = df.groupBy(F.window(F.col(ts_col), width).alias("w"), *keys).agg(*aggs)
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys,
                    *[c for c in g.columns if c not in ("w", *keys)])


def exact_mean(value: str, scale: int = 4) -> Column:
    """Mean of a 2-decimal column rounded half-up to ``scale`` decimals, exactly."""
    from strata.functions.money import money_mean
    return money_mean(value, scale)


def with_event_time(df: DataFrame, ts_col: str, out: str = "event_time") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ): reinterpret in the session zone (UTC)."""
    return df.withColumn(out, F.col(ts_col).cast("timestamp"))


def streaming_windows(stream: DataFrame, ts_col: str, width: str, delay: str, keys: list[str],
                      aggs: list[Column]) -> DataFrame:
    """Append-mode windowed aggregate: a window is emitted once the watermark
    (max event time - delay) passes its end; rows later than the watermark are dropped."""
    s = with_event_time(stream, ts_col).withWatermark("event_time", delay)
    return tumbling(s, "event_time", width, keys, aggs)


def speed_batch_merge(batch: DataFrame, speed: DataFrame, keys: list[str]) -> DataFrame:
    """Lambda merge: batch rows win; speed rows fill keys the batch layer does not have."""
    return batch.unionByName(speed.join(batch.select(*keys), on=keys, how="left_anti"))


def dedup_stream(stream: DataFrame, ts_col: str, keys: list[str], delay: str) -> DataFrame:
    """Streaming dedup: one row per key among rows within ``delay`` of each other;
    state older than the watermark is dropped so it stays bounded."""
    s = with_event_time(stream, ts_col).withWatermark("event_time", delay)
    return s.dropDuplicatesWithinWatermark(keys).drop("event_time")
