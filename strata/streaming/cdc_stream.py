"""Incremental CDC into log-structured state with ``foreachBatch`` (``log_state``).

SCD1 state keeps, per key, the winning event *including deletes* (a
tombstone), so a late event older than a delete cannot resurrect the key; the
published table filters tombstones out. SCD2 state keeps the deduplicated
events per key (including deletes) and derives the intervals on read, so a
late event splits the right interval. A micro-batch appends its own winners and
nothing else; replaying one after a crash (same events again) changes nothing.

The bucket count and the key types are fixed when the state is made: a fold with another count raises,
keys of another type are cast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.cdc import END, START
from strata.operators.ordered import next_in_key, time_chunk
from strata.session import path_exists
from strata.streaming.log_state import LogState


def scd1_fold(keys: list[str], seq: str, tiebreak: str | None, state: str, n_buckets: int):
    """foreachBatch function maintaining SCD1 state (with tombstones) under ``state``."""
    return LogState(state, list(keys), seq, [tiebreak] if tiebreak else [], n_buckets).fold()


def _stored_rows(spark: SparkSession, state: str) -> DataFrame:
    """Rows of a log-structured or a bucketed state, without the partition column."""
    if path_exists(spark, f"{state}/meta/_SUCCESS"):
        made = LogState.stored(spark, state)
        return made.read(spark).drop(made.part)
    return spark.read.parquet(state).drop("bucket")


def scd1_current(spark: SparkSession, state: str, delete_when: str, drop: list[str] = ()) -> DataFrame:
    return _stored_rows(spark, state).filter(~F.coalesce(F.expr(delete_when), F.lit(False))).drop(*drop)


def scd2_state(keys: list[str], seq: str, tiebreak: str | None, state: str, n_buckets: int) -> LogState:
    """State of all events, one for each key and sequence; the versions of a key share a bucket."""
    bucket = f"CAST(pmod(xxhash64({', '.join(keys)}), {n_buckets}) AS INT)"
    return LogState(state, [*keys, seq], None, [tiebreak] if tiebreak else [], n_buckets, ("bucket", bucket))


def scd2_fold(keys: list[str], seq: str, tiebreak: str | None, state: str, n_buckets: int):
    """foreachBatch function keeping the deduplicated event history."""
    fold = scd2_state(keys, seq, tiebreak, state, n_buckets).fold()
    return lambda batch, batch_id: fold(batch.filter(F.col(seq).isNotNull()), batch_id)


def scd2_history(spark: SparkSession, state: str, keys: list[str], seq: str, delete_when: str,
                 drop: list[str] = (), chunk_width: str = "1 day") -> DataFrame:
    ev = _stored_rows(spark, state).withColumn("__is_delete", F.coalesce(F.expr(delete_when), F.lit(False)))
    ev = next_in_key(ev, keys, [seq], seq, END, time_chunk(F.col(seq), chunk_width))
    return (ev.filter(~F.col("__is_delete")).withColumn(START, F.col(seq))
              .drop("__is_delete", *drop))


def scd1_stateful(stream: DataFrame, keys: list[str], seq: str, tiebreak: str | None, target: str,
                  n_buckets: int, checkpoint: str) -> None:
    """SCD1 with Spark's state store: an update-mode streaming aggregation keeps the
    winning event per key (max_by on (sequence present, sequence, -tiebreak)), and
    each micro-batch merges only the keys it changed into the bucketed target
    (touched buckets only). Deletes stay as tombstones; ``scd1_current`` publishes.

    ``tiebreak`` must be numeric (smaller = first seen wins).
    """
    from strata.operators.cdc import merge_into
    cols = [c for c in stream.columns if c not in keys]
    order = [F.col(seq).isNotNull(), F.col(seq)]
    if tiebreak:
        order.append(-F.col(tiebreak))
    latest = (stream.groupBy(*keys)
                    .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*order)).alias("__row"))
                    .select(*keys, "__row.*"))

    def publish(batch: DataFrame, batch_id: int) -> None:
        merge_into(batch.sparkSession, target, batch, keys, n_buckets, f"batch-{batch_id}")

    q = (latest.writeStream.outputMode("update").foreachBatch(publish)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
