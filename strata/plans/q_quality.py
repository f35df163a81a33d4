"""Quality queries: expectations, metrics, event log, gate, contracts, reconciliation,
and the quality sinks (quarantine, ingestion log, certification)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.operators import reconcile as R
from strata.operators import sinks as S
from strata.plans import views as V
from strata.plans.q_gold import SILVER_RULES, SLO_RULES
from strata.plans.registry import query
from strata.session import work_path

DATASET = "sgs_observacoes_stg"

COUNTS_SQL = """counts AS (SELECT COUNT(*) FILTER (WHERE codigo_serie IS NOT NULL) AS p0, COUNT(*) FILTER (WHERE NOT (codigo_serie IS NOT NULL) OR codigo_serie IS NULL) AS f0,
   COUNT(*) FILTER (WHERE COALESCE(valor IS NOT NULL AND valor >= 5, FALSE)) AS p1,
   COUNT(*) FILTER (WHERE NOT COALESCE(valor IS NOT NULL AND valor >= 5, FALSE)) AS f1,
   COUNT(*) FILTER (WHERE COALESCE(codigo_serie IN (1, 11, 433), FALSE)) AS p2,
   COUNT(*) FILTER (WHERE NOT COALESCE(codigo_serie IN (1, 11, 433), FALSE)) AS f2 FROM obs),
m AS (SELECT 'serie_presente' AS name, 'fail' AS action, p0 AS passed_records, f0 AS failed_records FROM counts
      UNION ALL SELECT 'valor_valido', 'drop', p1, f1 FROM counts
      UNION ALL SELECT 'serie_catalogada', 'warn', p2, f2 FROM counts)"""


@query("qlt_expect_warn", V.with_views("""
SELECT codigo_serie, data_ref, valor, event_id, COALESCE(codigo_serie IN (1, 11, 433), FALSE) AS ok_serie_catalogada FROM obs""", "obs"))
def qlt_expect_warn(spark, d):
    """QLT-1 WARN: every row kept, the rule's verdict kept beside it."""
    o = V.obs(spark, d)
    warn = [r for r in SILVER_RULES if r.action == Q.WARN]
    return Q.rule_flags(Q.expect(o, warn), warn).select("codigo_serie", "data_ref", "valor", "event_id", "ok_serie_catalogada")


@query("qlt_expect_drop", V.with_views("""
SELECT codigo_serie, data_ref, valor, event_id FROM obs WHERE valor IS NOT NULL AND valor >= 5""", "obs"))
def qlt_expect_drop(spark, d):
    """QLT-1 DROP (with FAIL and WARN rules applied too): violating rows removed."""
    return Q.expect(V.obs(spark, d), SILVER_RULES).select("codigo_serie", "data_ref", "valor", "event_id")


@query("qlt_metrics", V.with_views(f""", {COUNTS_SQL}
SELECT '{DATASET}' AS dataset, * FROM m""", "obs"))
def qlt_metrics(spark, d):
    """QLT-2: (dataset, name, passed, failed) per rule from one aggregate pass."""
    return Q.expectation_metrics(V.obs(spark, d), SILVER_RULES, DATASET)


def _event_log(spark, d):
    """One flow_progress event per day holding that day's expectation counts (as JSON)."""
    per_day = Q.expectation_metrics(V.obs(spark, d), SILVER_RULES, DATASET, by=["data_ref"])
    return Q.to_event_log(per_day, ["data_ref"])


@query("qlt_event_log", V.with_views(f""", {COUNTS_SQL}
SELECT '{DATASET}' AS dataset, name, passed_records AS aprovados, failed_records AS reprovados FROM m""", "obs"))
def qlt_event_log(spark, d):
    """QLT-3 / SRC-14: expectation counts parsed back from the JSON event log, summed per rule."""
    return Q.metrics_from_event_log(_event_log(spark, d))


GATE_SQL = V.with_views(f""", {COUNTS_SQL}
SELECT CASE WHEN ROUND(f / GREATEST(p + f, 1), 6) <= 0.05 THEN 'OK' ELSE 'ALERTA' END AS status,
       ROUND(f / GREATEST(p + f, 1), 6) AS rate, CAST(p AS BIGINT) AS passed, CAST(f AS BIGINT) AS failed
FROM (SELECT SUM(passed_records) AS p, SUM(failed_records) AS f FROM m {{where}})""", "obs")


@query("qlt_gate", GATE_SQL.format(where=""))
def qlt_gate(spark, d):
    """QLT-4: violation rate = failed / max(total, 1) over the run's event log; OK if <= 5 %."""
    return Q.quality_gate(Q.metrics_from_event_log(_event_log(spark, d)))


@query("qlt_gate_dropped", GATE_SQL.format(where="WHERE action = 'drop'"))
def qlt_gate_dropped(spark, d):
    """QLT-4 (SLO text): rate of dropped rows only."""
    m = Q.expectation_metrics(V.obs(spark, d), SILVER_RULES, DATASET).filter(F.col("action") == Q.DROP)
    return Q.quality_gate(m, passed_col="passed_records", failed_col="failed_records", mode="dropped_rows")


LI_RULES = [Q.Rule("quantidade_positiva", "l_quantity > 0"), Q.Rule("desconto_valido", "l_discount BETWEEN 0 AND 0.08")]
LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("qlt_table_metrics", "SELECT 'total_rows' AS metric, NULL::VARCHAR AS \"column\", COUNT(*) AS value FROM lineitem "
       "UNION ALL SELECT 'duplicate_keys', 'l_orderkey,l_linenumber', COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem "
       + " ".join(f"UNION ALL SELECT 'null_count', '{c}', COUNT(*) FILTER (WHERE {c} IS NULL) FROM lineitem" for c in LI_COLS)
       + " UNION ALL SELECT 'rule_failures', 'quantidade_positiva', COUNT(*) FILTER (WHERE NOT COALESCE(l_quantity > 0, FALSE)) FROM lineitem"
       + " UNION ALL SELECT 'rule_failures', 'desconto_valido', COUNT(*) FILTER (WHERE NOT COALESCE(l_discount BETWEEN 0 AND 0.08, FALSE)) FROM lineitem")
def qlt_table_metrics(spark, d):
    """QLT-6: total, NULLs per column, duplicate keys and rule failures in one pass."""
    li = V.table(spark, d, "lineitem").select(*LI_COLS)
    return Q.table_quality(li, ["l_orderkey", "l_linenumber"], LI_RULES, LI_COLS)


CONTRACT = Q.Contract(
    columns={"o_orderkey": ("bigint", False), "o_custkey": ("bigint", False), "o_totalprice": ("double", False),
             "o_orderdate": ("timestamp_ntz", False), "o_orderstatus": ("string", True)},
    unique_key=["o_orderkey"],
    rules=[Q.Rule("preco_positivo", "o_totalprice > 0"),
           Q.Rule("data_nao_futura", "o_orderdate <= TIMESTAMP_NTZ '2001-09-01 00:00:00'")],
    freshness_col="o_orderdate", max_age_hours=24 * 60)
CONTRACT_AS_OF = datetime(2001, 9, 1)


@query("qlt_contract", """
SELECT * FROM (VALUES ('type:o_orderkey', TRUE, 'bigint'), ('type:o_custkey', TRUE, 'bigint'), ('type:o_totalprice', TRUE, 'double'),
                      ('type:o_orderdate', TRUE, 'timestamp_ntz'), ('type:o_orderstatus', TRUE, 'string')) t("check", passed, detail)
UNION ALL SELECT 'unique_key', COUNT(*) = COUNT(DISTINCT o_orderkey), CAST(COUNT(*) - COUNT(DISTINCT o_orderkey) AS VARCHAR) FROM orders
UNION ALL SELECT 'not_null:o_orderkey', COUNT(*) FILTER (WHERE o_orderkey IS NULL) = 0, CAST(COUNT(*) FILTER (WHERE o_orderkey IS NULL) AS VARCHAR) FROM orders
UNION ALL SELECT 'not_null:o_custkey', COUNT(*) FILTER (WHERE o_custkey IS NULL) = 0, CAST(COUNT(*) FILTER (WHERE o_custkey IS NULL) AS VARCHAR) FROM orders
UNION ALL SELECT 'not_null:o_totalprice', COUNT(*) FILTER (WHERE o_totalprice IS NULL) = 0, CAST(COUNT(*) FILTER (WHERE o_totalprice IS NULL) AS VARCHAR) FROM orders
UNION ALL SELECT 'not_null:o_orderdate', COUNT(*) FILTER (WHERE o_orderdate IS NULL) = 0, CAST(COUNT(*) FILTER (WHERE o_orderdate IS NULL) AS VARCHAR) FROM orders
UNION ALL SELECT 'rule:preco_positivo', COUNT(*) FILTER (WHERE NOT COALESCE(o_totalprice > 0, FALSE)) = 0,
    CAST(COUNT(*) FILTER (WHERE NOT COALESCE(o_totalprice > 0, FALSE)) AS VARCHAR) FROM orders
UNION ALL SELECT 'rule:data_nao_futura', COUNT(*) FILTER (WHERE NOT COALESCE(o_orderdate <= TIMESTAMP '2001-09-01', FALSE)) = 0,
    CAST(COUNT(*) FILTER (WHERE NOT COALESCE(o_orderdate <= TIMESTAMP '2001-09-01', FALSE)) AS VARCHAR) FROM orders
UNION ALL SELECT 'freshness', COALESCE(epoch(TIMESTAMP '2001-09-01') / 3600.0 - epoch(MAX(o_orderdate)) / 3600.0 <= 1440, FALSE),
    CAST(ROUND(epoch(TIMESTAMP '2001-09-01') / 3600.0 - epoch(MAX(o_orderdate)) / 3600.0, 3) AS VARCHAR) FROM orders""")
def qlt_contract(spark, d):
    """QLT-7: data contract (types, nullability, unique key, rules, freshness)."""
    return Q.check_contract(V.table(spark, d, "orders"), CONTRACT, CONTRACT_AS_OF)


@query("qlt_reconcile", V.with_views("""
, s AS (SELECT order_date, CAST(SUM(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM fact_lines GROUP BY 1)
SELECT 'revenue' AS measure, CAST(SUM(CAST(revenue AS DECIMAL(38,4))) AS DOUBLE) AS detail_total,
       (SELECT CAST(SUM(CAST(revenue AS DECIMAL(38,4))) AS DOUBLE) FROM s) AS summary_total, CAST(0 AS DOUBLE) AS diff, TRUE AS ok
FROM fact_lines""", "fact_lines"))
def qlt_reconcile(spark, d):
    """QLT-10: gold reconciliation, detail total = summary total."""
    f = V.fact_lines(spark, d)
    summary = f.groupBy("order_date").agg(F.sum(F.col("revenue").cast("decimal(18,2)")).cast("double").alias("revenue"))
    return Q.reconcile(f, summary, {"revenue": "revenue"})


def _kept(spark, rows, name):
    path = work_path(spark, name)
    R.keep(rows, path, ["o_orderkey"], 64)
    return path


@query("qlt_reconcile_tables", """
SELECT CASE WHEN k % 503 = 1 THEN 'changed' WHEN k % 503 = 2 THEN 'only_left' ELSE 'only_right' END AS kind,
       CASE WHEN k % 503 = 3 THEN -k ELSE k END AS o_orderkey,
       CAST(CASE WHEN k % 503 = 3 THEN 0 ELSE 1 END AS BIGINT) AS left_rows, CAST(CASE WHEN k % 503 = 2 THEN 0 ELSE 1 END AS BIGINT) AS right_rows
FROM (SELECT o_orderkey AS k FROM orders) WHERE k % 503 IN (1, 2, 3)""")
def qlt_reconcile_tables(spark, d):
    """QLT-10: two stored tables by checksums of key ranges; changed, lost and added orders are located.

    The second table is derived: one order in 503 has another price, one is missing, one is there again under a new key.
    """
    o = V.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    k = F.col("o_orderkey")
    second = (o.where(k % 503 != 2).withColumn("o_totalprice", F.when(k % 503 == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
              .unionByName(o.where(k % 503 == 3).withColumn("o_orderkey", -k)))
    return R.differences(spark, _kept(spark, o, "first-orders"), _kept(spark, second, "second-orders"))


@query("qlt_reconcile_same", """
SELECT 'equal' AS kind, CAST(NULL AS BIGINT) AS o_orderkey, COUNT(*) AS left_rows, COUNT(*) AS right_rows FROM orders""")
def qlt_reconcile_same(spark, d):
    """QLT-10: a table and a copy written in another order; one row says that they are equal."""
    o = V.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return R.differences(spark, _kept(spark, o, "first-orders"), _kept(spark, o.repartition(5, "o_custkey"), "second-orders"))


@query("qlt_freshness", """
SELECT 'events' AS table_name, MAX(ts) AS latest,
       ROUND((epoch(TIMESTAMP '2024-01-31 06:00:00') - epoch(MAX(ts))) / 3600.0, 3) AS lag_hours,
       (epoch(TIMESTAMP '2024-01-31 06:00:00') - epoch(MAX(ts))) / 3600.0 <= 24 AS ok FROM events""")
def qlt_freshness(spark, d):
    """QLT-10: freshness SLA (newest row within 24 h of the as-of time)."""
    return Q.freshness(V.table(spark, d, "events"), "ts", datetime(2024, 1, 31, 6), 24, "events")


LOG_SQL = """log AS (SELECT event_type AS table_name, CAST(ts AS DATE) AS load_date, CAST(hour(ts) // 6 AS INTEGER) AS load_id,
    COUNT(*) AS row_count,
    CASE WHEN COUNT(*) FILTER (WHERE value < 5) > 0.05 * COUNT(*) THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    MAX(ts) AS logged_at FROM events GROUP BY 1, 2, 3)"""


def _ingestion_log(spark, d):
    e = V.table(spark, d, "events").withColumn("load_date", F.col("ts").cast("date")) \
        .withColumn("load_id", F.floor(F.hour("ts") / 6).cast("int"))
    status = F.when(F.count_if(F.col("value") < 5) > 0.05 * F.count(F.lit(1)), F.lit("FAILED")).otherwise(F.lit("SUCCESS"))
    return S.ingestion_log_rows(e, "event_type", "load_date", "load_id", status, F.max("ts"))


@query("snk_ingestion_log", f"WITH {LOG_SQL} SELECT * FROM log")
def snk_ingestion_log(spark, d):
    """SNK-7: one audit row per load (table, day, 6-hour load) with count and status, appended to the stored log."""
    target = work_path(spark, "ingestion-log")
    S.append_batch(_ingestion_log(spark, d), target)
    return spark.read.parquet(target)


@query("qlt_ingestion_sla", f"""WITH {LOG_SQL}
SELECT table_name, load_date, COUNT(*) AS loads, COUNT(*) FILTER (WHERE status = 'SUCCESS') AS successes,
       COUNT(*) FILTER (WHERE status <> 'SUCCESS') AS failures, MAX(logged_at) AS last_load FROM log GROUP BY 1, 2""")
def qlt_ingestion_sla(spark, d):
    """QLT-11: loads, successes, failures and last load per table and day."""
    return Q.ingestion_sla(_ingestion_log(spark, d))


QUARANTINE_AS_OF = datetime(2024, 2, 1)


@query("snk_quarantine", """
SELECT TIMESTAMP '2024-02-01 00:00:00' AS quarantined_at,
  concat_ws(',', CASE WHEN NOT COALESCE(value >= 5, FALSE) THEN 'valor_valido' END,
                 CASE WHEN NOT COALESCE(event_type IN ('view', 'click', 'purchase'), FALSE) THEN 'serie_catalogada' END) AS reason,
  concat_ws('; ', CASE WHEN NOT COALESCE(value >= 5, FALSE) THEN 'valor_valido: value >= 5' END,
                  CASE WHEN NOT COALESCE(event_type IN ('view', 'click', 'purchase'), FALSE)
                       THEN 'serie_catalogada: event_type IN (''view'', ''click'', ''purchase'')' END) AS detail,
  CAST(to_json(struct_pack(event_id := event_id, ts := strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), user_id := user_id, event_type := event_type, value := value, props := props)) AS VARCHAR) AS record,
  'events' AS source, CAST(ts AS DATE) AS data_ref
FROM events WHERE NOT COALESCE(value >= 5, FALSE) OR NOT COALESCE(event_type IN ('view', 'click', 'purchase'), FALSE)""")
def snk_quarantine(spark, d):
    """SNK-6 / QLT-8: failing rows to a quarantine table with reason, detail and the full record."""
    e = V.table(spark, d, "events").withColumn("data_ref", F.col("ts").cast("date"))
    rules = [Q.Rule("valor_valido", "value >= 5", Q.DROP),
             Q.Rule("serie_catalogada", "event_type IN ('view', 'click', 'purchase')", Q.DROP)]
    target = work_path(spark, "quarantine")
    record = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    S.append_batch(S.quarantine(e, rules, "events", QUARANTINE_AS_OF, record, ["data_ref"]), target, ["data_ref"])
    return spark.read.parquet(target)


@query("snk_certify", V.with_views(f""", {COUNTS_SQL.replace("valor >= 5", "valor >= 1")},
g AS (SELECT ROUND(SUM(failed_records) / GREATEST(SUM(passed_records) + SUM(failed_records), 1), 6) AS rate FROM m
      WHERE action = 'drop')
SELECT t.table_name, 'OK' AS status, g.rate, TIMESTAMP '2024-02-01 00:00:00' AS certified_at
FROM g, (VALUES ('indicadores_mensais'), ('ipca_expectativa_vs_realizado')) t(table_name) WHERE g.rate <= 0.05""", "obs"))
def snk_certify(spark, d):
    """SNK-8: gold tables certified, and the rows stored, only when the gate (5 % of dropped rows) says OK."""
    m = Q.expectation_metrics(V.obs(spark, d), SLO_RULES, DATASET).filter(F.col("action") == Q.DROP)
    status, rate = Q.gate_verdict(m, passed_col="passed_records", failed_col="failed_records")
    target = work_path(spark, "certification")
    S.append_batch(S.certify(spark, ["indicadores_mensais", "ipca_expectativa_vs_realizado"], status, rate, QUARANTINE_AS_OF), target)
    return spark.read.parquet(target)
