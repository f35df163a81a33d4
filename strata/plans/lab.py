"""The lab's three feeds end to end: landing -> bronze -> silver -> gate -> gold, with change propagation.

bronze : raw JSON lines of each feed, typed by a frozen schema, with audit columns and ``_rescued_data``
silver : series envelopes exploded and typed -> rules -> SCD1 by (series, day), partitioned by month;
         market expectations exploded -> rules -> SCD1 by (indicator, report day, month), partitioned by month;
         customer change events -> rules -> SCD1 and SCD2
         Each micro-batch notes its rule counts and the months that its *raw* rows touch.
gate   : share of dropped rows over the batches that no certification covers
gold   : monthly indicators, and expected against realized value of one series. Only months noted since
         the last refresh are read from silver and replaced; a month without rows left vanishes.

Every step may be repeated: states merge, notes are written by batch, and the notes of a refresh are
removed only after both gold tables are written. ``full_refresh`` drops all tables and checkpoints first.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.money import money_mean
from strata.functions.parsing import parse_brl, parse_date_br, parse_month_br
from strata.operators import aggregates as A
from strata.operators import quality as Q
from strata.operators import sinks as S
from strata.plans.q_cdc import CDC_RULES
from strata.session import path_exists, remove_path
from strata.sources.files import with_file_metadata
from strata.sources.rescue import CORRUPT, RESCUED, read_rescued
from strata.streaming import cdc_stream as CS
from strata.streaming.ingest import append_stream, run_foreach_batch
from strata.streaming.log_state import LogState

# The payload fields of the three feeds.
SCHEMAS = {
    "sgs": "codigo_serie INT, nome_serie STRING, coletado_em TIMESTAMP_NTZ, fonte STRING, observacoes ARRAY<STRUCT<data: STRING, valor: STRING>>",
    "expectativas": "coletado_em TIMESTAMP_NTZ, endpoint STRING, payload STRUCT<value: ARRAY<STRUCT<Indicador: STRING, Data: STRING, DataReferencia: STRING, Media: DOUBLE, Mediana: DOUBLE, numeroRespondentes: INT>>>",
    "clientes": "cliente_id BIGINT, nome STRING, uf STRING, segmento STRING, email STRING, cpf STRING, operacao STRING, ts_evento TIMESTAMP_NTZ, event_id BIGINT",
}
RULES = {
    "sgs": [Q.Rule("serie_presente", "codigo_serie IS NOT NULL", Q.FAIL),
            Q.Rule("valor_valido", "valor IS NOT NULL AND NOT isnan(valor) AND valor >= 0", Q.DROP),
            Q.Rule("data_valida", "data_ref IS NOT NULL", Q.DROP),
            Q.Rule("serie_catalogada", "codigo_serie IN (1, 11, 433)", Q.WARN)],
    "expectativas": [Q.Rule("mediana_valida", "mediana IS NOT NULL", Q.DROP),
                     Q.Rule("mes_valido", "mes IS NOT NULL", Q.DROP)],
    "clientes": CDC_RULES,
}
REALIZED = 433  # fixed value: the inflation series


class GateRejected(Exception):
    """The quality gate is on ALERTA; gold and certification are as they were before the run."""


@dataclass
class Lab:
    """Tables of one run under ``root``."""
    root: str
    buckets: int = 16
    gold: dict[str, str] = field(init=False)

    def __post_init__(self):
        self.gold = {n: f"{self.root}/gold/{n}" for n in ("indicadores_mensais", "expectativa_vs_realizado")}
        month = lambda c: ("mes", f"CAST(date_trunc('month', {c}) AS DATE)")
        self.observations = LogState(f"{self.root}/silver/observacoes", ["codigo_serie", "data_ref"], "coletado_em", ["valor"], partition=month("data_ref"))
        self.expectations = LogState(f"{self.root}/silver/expectativas", ["indicador", "data_boletim", "mes"], "coletado_em", ["mediana"], partition=month("mes"))
        self.current = LogState(f"{self.root}/silver/clientes_atual", ["cliente_id"], "ts_evento", ["event_id"], self.buckets)
        self.history = CS.scd2_state(["cliente_id"], "ts_evento", "event_id", f"{self.root}/silver/clientes_historico", self.buckets)

    def notes(self, feed: str) -> str:
        return f"{self.root}/changes/{feed}"


def to_bronze(spark: SparkSession, lab: Lab, feed: str, landing: str, as_of: datetime) -> None:
    """Append the feed's new landing files; what the frozen schema has no place for goes to ``_rescued_data``."""
    raw = with_file_metadata(spark.readStream.format("text").load(landing), ingested_at=as_of)
    schema = T._parse_datatype_string(SCHEMAS[feed])
    q = append_stream(read_rescued(raw, "value", schema), f"{lab.root}/bronze/{feed}", f"{lab.root}/_checkpoints/bronze-{feed}")
    q.awaitTermination()


def typed_observations(bronze: DataFrame) -> DataFrame:
    """One row per observation of the series envelopes."""
    one = bronze.filter(~F.col(CORRUPT)).select("codigo_serie", "nome_serie", "coletado_em", F.explode("observacoes").alias("o"))
    return one.select("codigo_serie", "nome_serie", parse_date_br("o.data").alias("data_ref"), parse_brl("o.valor").alias("valor"), "coletado_em")


def typed_expectations(bronze: DataFrame) -> DataFrame:
    """One row per market expectation of the report envelopes."""
    one = bronze.filter(~F.col(CORRUPT)).select("coletado_em", F.explode("payload.value").alias("v"))
    return one.select(F.col("v.Indicador").alias("indicador"), F.to_date("v.Data").alias("data_boletim"), parse_month_br("v.DataReferencia").alias("mes"),
                      F.col("v.Mediana").alias("mediana"), "coletado_em")


def _note(spark: SparkSession, lab: Lab, feed: str, months: DataFrame, batch_id: int) -> None:
    months.where("mes IS NOT NULL").distinct().coalesce(1).write.mode("overwrite").parquet(f"{lab.notes(feed)}/batch={batch_id}")


def to_silver(spark: SparkSession, lab: Lab, feed: str) -> None:
    """Fold the feed's new bronze rows into silver, micro-batch by micro-batch."""
    bronze = f"{lab.root}/bronze/{feed}"
    if not path_exists(spark, bronze):
        return
    rules, log = RULES[feed], f"{lab.root}/monitoring/event_log"
    typed = {"sgs": typed_observations, "expectativas": typed_expectations, "clientes": lambda b: b.filter(~F.col(CORRUPT))}[feed]
    month: dict[str, Column] = {"sgs": A.month_of("data_ref"), "expectativas": F.col("mes")}

    def fold(batch: DataFrame, batch_id: int) -> None:
        rows = typed(batch)
        if feed == "clientes":
            rows = rows.select([f.name for f in T._parse_datatype_string(SCHEMAS[feed]).fields])
        rows = rows.persist()  # counts, states and notes read it
        metrics = Q.expectation_metrics(rows, rules, feed)
        metrics.coalesce(1).write.mode("overwrite").parquet(f"{log}/feed={feed}/batch={batch_id}")
        good = Q.expect(rows, rules)
        if feed == "clientes":
            lab.current.append(good, batch_id)
            lab.history.append(good.filter("ts_evento IS NOT NULL"), batch_id)
        else:
            (lab.observations if feed == "sgs" else lab.expectations).append(good, batch_id)
            _note(spark, lab, feed, rows.select(month[feed].alias("mes")), batch_id)
        rows.unpersist()

    source = spark.readStream.schema(spark.read.parquet(bronze).schema).parquet(bronze)
    run_foreach_batch(source, fold, f"{lab.root}/_checkpoints/silver-{feed}")
    for state in {"sgs": [lab.observations], "expectativas": [lab.expectations], "clientes": [lab.current, lab.history]}[feed]:
        state.compact_if_due(spark)


def indicators(observations: DataFrame) -> DataFrame:
    """Monthly indicators; the mean is exact, from integer cents."""
    return A.monthly_indicators(observations, mean=money_mean("valor", 4))


def gate(spark: SparkSession, lab: Lab, limit: float) -> tuple[str, float, dict[str, int]]:
    """(status, rate, last batch of each feed) over the batches that no certification covers; only DROP rules count."""
    log, certified = f"{lab.root}/monitoring/event_log", f"{lab.root}/monitoring/certification"
    counts = spark.read.parquet(log).filter(F.col("action") == Q.DROP)
    last = {r.feed: r.last for r in spark.read.parquet(log).groupBy("feed").agg(F.max("batch").alias("last")).collect()}
    if path_exists(spark, certified):
        covered = spark.read.parquet(certified).groupBy("feed").agg(F.max("batch").alias("upto"))
        counts = counts.join(covered, "feed", "left").filter(F.col("upto").isNull() | (F.col("batch") > F.col("upto")))
    status, rate = Q.gate_verdict(counts, limit, passed_col="passed_records", failed_col="failed_records")
    return status, rate, last


def to_gold(spark: SparkSession, lab: Lab) -> list:
    """Refresh the months noted since the last refresh; the months."""
    queue = [f for feed in ("sgs", "expectativas") for f in _batches(spark, lab.notes(feed))]
    if not queue:
        return []
    touched = spark.read.parquet(*queue).distinct().persist()
    months = sorted(r.mes for r in touched.collect())  # names of partitions
    if months:
        some = F.col("mes").isin(months)

        def silver(state: LogState, empty: str) -> DataFrame:
            return state.read(spark, some) if state.exists(spark) else spark.createDataFrame([], empty)

        obs = silver(lab.observations, "codigo_serie INT, nome_serie STRING, data_ref DATE, valor DOUBLE, coletado_em TIMESTAMP_NTZ, mes DATE").drop("mes")
        exp = silver(lab.expectations, "indicador STRING, data_boletim DATE, mes DATE, mediana DOUBLE, coletado_em TIMESTAMP_NTZ")
        S.refresh_partitions(spark, lab.gold["indicadores_mensais"], obs, ["mes"], indicators, touched)
        S.refresh_partitions(spark, lab.gold["expectativa_vs_realizado"], obs, ["mes"],
                             lambda o: A.expectation_vs_realized(o, exp, code=REALIZED, expected_month="mes", expected_mean=money_mean("mediana", 4)), touched)
    touched.unpersist()
    for folder in queue:
        remove_path(spark, folder)
    return months


def _batches(spark: SparkSession, path: str) -> list[str]:
    if not path_exists(spark, path):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
    return sorted(f"{path}/{n}" for n in names if path_exists(spark, f"{path}/{n}/_SUCCESS"))


def run(spark: SparkSession, landing: dict[str, str], root: str, as_of: datetime, limit: float = Q.DEFAULT_LIMIT, full_refresh: bool = False) -> tuple[Lab, list]:
    """One triggered run over the landing folders (feed -> folder); the tables and the months refreshed. Raises
    ``GateRejected`` over the limit: silver keeps the rows, gold waits, and the next run judges these batches again."""
    if full_refresh:
        remove_path(spark, root)
    lab = Lab(root)
    for feed, folder in landing.items():
        if path_exists(spark, folder):  # else nothing has landed yet
            to_bronze(spark, lab, feed, folder, as_of)
            to_silver(spark, lab, feed)
    if not path_exists(spark, f"{root}/monitoring/event_log"):
        return lab, []
    status, rate, last = gate(spark, lab, limit)
    if status != Q.STATUS_OK:
        raise GateRejected(f"{status}: {rate:.4%} of the rows dropped")
    months = to_gold(spark, lab)
    cert = S.certify(spark, list(lab.gold), status, rate, as_of)
    upto = F.array(*[F.struct(F.lit(f).alias("feed"), F.lit(b).cast("long").alias("batch")) for f, b in last.items()])
    S.append_batch(cert.select("*", F.inline(upto)).coalesce(1), f"{root}/monitoring/certification")
    return lab, months
