"""One triggered bronze -> silver -> gate -> gold run over landing files.

bronze : landing JSON -> file stream (availableNow) -> parquet + audit columns
silver : bronze stream -> series observations -> expectations (FAIL/DROP/WARN)
         -> foreachBatch: per-batch expectation counts appended to an event
            log, rows folded into a bucketed SCD1 state (latest per series/day)
gate   : violation rate over all batches that no certification covers yet; ALERTA
         raises before gold is written, also on a rerun without new files
gold   : monthly indicators written (overwrite); the certification is appended to a
         stored table with the last batch that it covers

``full_refresh=True`` starts every table and checkpoint from scratch, so the
run rebuilds everything from the landing files.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import aggregates as A
from strata.operators import quality as Q
from strata.operators import sinks as S
from strata.plans import views as V
from strata.plans.q_gold import SILVER_RULES
from strata.session import path_exists, remove_path
from strata.sources.landing import TS_FORMAT
from strata.streaming import cdc_stream as CS
from strata.streaming.ingest import ingest_available_now, run_foreach_batch

BRONZE_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
                 "props STRING, day STRING")
DATASET = "sgs_observacoes_stg"


@dataclass
class RunResult:
    status: str
    rate: float
    gold: str
    certification: DataFrame


class GateRejected(Exception):
    """The quality gate is on ALERTA; gold and the certification are as they were before the run."""

    def __init__(self, status: str, rate: float, gold: str):
        super().__init__(f"quality gate {status} (rate {rate}); {gold} not written")
        self.status, self.rate, self.gold = status, rate, gold


def run(spark: SparkSession, landing: str, root: str, run_id: str, as_of: datetime,
        limit: float = Q.DEFAULT_LIMIT, n_buckets: int = 16, gate_mode: str = "violations",
        rules: list[Q.Rule] = SILVER_RULES, full_refresh: bool = False) -> RunResult:
    """``gate_mode='violations'``: every failed record (WARN too) over all checks, the
    lab's audit code; ``'dropped_rows'``: rows removed by DROP rules over rows seen,
    the lab's written SLO. Raises ``GateRejected`` over the limit."""
    if full_refresh:
        remove_path(spark, root)
    bronze, ck_b = f"{root}/bronze/events", f"{root}/_checkpoints/bronze"
    state, ck_s = f"{root}/silver/observacoes_state", f"{root}/_checkpoints/silver"
    log, gold = f"{root}/monitoring/event_log", f"{root}/gold/indicadores_mensais"
    certified = f"{root}/monitoring/certification"

    ingest_available_now(spark, landing, "json", BRONZE_SCHEMA, bronze, ck_b, ingested_at=as_of,
                         timestampNTZFormat=TS_FORMAT)

    fold = CS.scd1_fold(["codigo_serie", "data_ref"], "seq", "event_id", state, n_buckets)

    def silver_batch(batch: DataFrame, batch_id: int) -> None:
        obs = V.observations(batch).persist()  # read twice: counts and fold
        # counts of this micro-batch -> event log (a replayed batch replaces its own entry)
        m = Q.expectation_metrics(obs, rules, DATASET)
        ev = Q.to_event_log(m.withColumn("run_id", F.lit(run_id)).withColumn("batch_id", F.lit(batch_id)),
                            ["run_id", "batch_id"])
        ev.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
          .partitionBy("batch_id").parquet(log)
        fold(Q.expect(obs, rules), batch_id)
        obs.unpersist()

    src = spark.readStream.schema(spark.read.parquet(bronze).schema).parquet(bronze)
    run_foreach_batch(src, silver_batch, ck_s)

    events, last = spark.read.parquet(log), -1
    if path_exists(spark, certified):
        last = spark.read.parquet(certified).agg(F.max("batch_id")).first()[0]
    metrics = Q.metrics_from_event_log(events.filter(F.col("batch_id") > last))
    if gate_mode == "dropped_rows":
        metrics = metrics.filter(F.col("name").isin([r.name for r in rules if r.action == Q.DROP]))
    status, rate = Q.gate_verdict(metrics, limit)
    if status != Q.STATUS_OK:
        raise GateRejected(status, rate, gold)
    silver = CS.scd1_current(spark, state, "false")
    S.overwrite(A.monthly_indicators(silver), gold)
    cert = S.certify(spark, ["indicadores_mensais"], status, rate, as_of)
    covers = events.agg(F.max("batch_id")).first()[0]
    S.append_batch(cert.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(covers).cast("long")}), certified)
    return RunResult(status, rate, gold, spark.read.parquet(certified).filter(F.col("run_id") == run_id))
