"""Change-data-capture queries: SCD1, SCD2, upserts, snapshot SCD2, point-in-time joins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from strata.operators import cdc as C
from strata.operators import sinks as S
from strata.operators import stored as ST
from strata.operators.dedup import dedup_latest
from strata.operators.quality import DROP, FAIL, WARN, Rule, expect
from strata.plans import views as V
from strata.plans.registry import query
from strata.session import work_path

# Expectations of the customer change feed (key present, valid e-mail, known state).
CDC_RULES = [
    Rule("chave_presente", "cliente_id IS NOT NULL", FAIL),
    Rule("email_valido", "email LIKE '%@%'", DROP),
    Rule("uf_conhecida", "uf IN ('SP','RJ','MG','RS','PR','BA')", WARN),
]
CDC_COLS = ["cliente_id", "nome", "uf", "segmento", "email", "cpf", "ts_evento"]
CDC_COLS_SQL = ", ".join(CDC_COLS)

STG_SQL = "stg AS (SELECT * FROM clientes_cdc WHERE email LIKE '%@%')"
SCD2_SQL = f"""{STG_SQL},
ev AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cliente_id, ts_evento ORDER BY event_id) AS rn
       FROM stg) WHERE rn = 1),
hist AS (SELECT {CDC_COLS_SQL}, ts_evento AS __START_AT,
                LEAD(ts_evento) OVER (PARTITION BY cliente_id ORDER BY ts_evento) AS __END_AT, operacao FROM ev),
scd2 AS (SELECT * EXCLUDE (operacao) FROM hist WHERE operacao <> 'DELETE')"""


def clientes_stg(spark, d):
    return expect(V.clientes_cdc(spark, d), CDC_RULES)


def clientes_scd2(spark, d):
    return C.scd2(clientes_stg(spark, d), ["cliente_id"], "ts_evento", tiebreak="event_id",
                  delete_when="operacao = 'DELETE'", except_cols=("operacao", "event_id"))


@query("cdc_scd1", V.with_views(f""", {STG_SQL},
latest AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cliente_id ORDER BY ts_evento DESC NULLS LAST, event_id)
           AS rn FROM stg) WHERE rn = 1)
SELECT {CDC_COLS_SQL} FROM latest WHERE operacao <> 'DELETE'""", "clientes_cdc"))
def cdc_scd1(spark, d):
    """CDC-1: one row per customer, latest event wins, a winning DELETE removes the key."""
    return C.scd1(clientes_stg(spark, d), ["cliente_id"], "ts_evento", tiebreak="event_id",
                  delete_when="operacao = 'DELETE'", except_cols=("operacao", "event_id"))


@query("cdc_scd2", V.with_views(f", {SCD2_SQL}\nSELECT * FROM scd2", "clientes_cdc"))
def cdc_scd2(spark, d):
    """CDC-2 / WIN-2: full history; each event opens a version ended by the next; deletes close."""
    return clientes_scd2(spark, d)


@query("cdc_current", V.with_views(f", {SCD2_SQL}\nSELECT * FROM scd2 WHERE __END_AT IS NULL", "clientes_cdc"))
def cdc_current(spark, d):
    """CDC-3: current snapshot of the SCD2 table."""
    return C.current_rows(clientes_scd2(spark, d))


AS_OF = datetime(2024, 1, 15, 12, 0, 0)


@query("cdc_as_of", V.with_views(f""", {SCD2_SQL}
SELECT * FROM scd2 WHERE __START_AT <= TIMESTAMP '2024-01-15 12:00:00'
  AND (__END_AT IS NULL OR __END_AT > TIMESTAMP '2024-01-15 12:00:00')""", "clientes_cdc"))
def cdc_as_of(spark, d):
    """CDC-4: the dimension as it was at a past instant."""
    return C.versions_as_of(clientes_scd2(spark, d), AS_OF)


# ------------------------------------------------------------------ upserts

T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 2)
SNAP_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _target(spark, d):
    return V.snapshot_1(spark, d).withColumn("_atualizado_em", F.lit(T0).cast("timestamp_ntz"))


UPSERT_SQL = """j AS (SELECT COALESCE(t.c_custkey, s.c_custkey) AS c_custkey, t.c_custkey IS NOT NULL AS in_t,
       s.c_custkey IS NOT NULL AS in_s,
       (t.c_name IS DISTINCT FROM s.c_name OR t.c_nationkey IS DISTINCT FROM s.c_nationkey OR
        t.c_acctbal IS DISTINCT FROM s.c_acctbal OR t.c_mktsegment IS DISTINCT FROM s.c_mktsegment) AS diff,
       t.c_name AS t_name, t.c_nationkey AS t_nation, t.c_acctbal AS t_bal, t.c_mktsegment AS t_seg,
       s.c_name AS s_name, s.c_nationkey AS s_nation, s.c_acctbal AS s_bal, s.c_mktsegment AS s_seg
   FROM snapshot_1 t FULL OUTER JOIN snapshot_2 s ON t.c_custkey = s.c_custkey),
a AS (SELECT *, CASE WHEN in_s AND NOT in_t THEN 'insert' WHEN in_s AND in_t AND diff THEN 'update'
                     WHEN in_s AND in_t THEN 'unchanged' ELSE '{missing}' END AS _action FROM j),
r AS (SELECT c_custkey,
        CASE WHEN _action IN ('insert', 'update') THEN s_name ELSE t_name END AS c_name,
        CASE WHEN _action IN ('insert', 'update') THEN s_nation ELSE t_nation END AS c_nationkey,
        CASE WHEN _action IN ('insert', 'update') THEN s_bal ELSE t_bal END AS c_acctbal,
        CASE WHEN _action IN ('insert', 'update') THEN s_seg ELSE t_seg END AS c_mktsegment,
        CASE WHEN _action IN ('insert', 'update') THEN TIMESTAMP '2024-01-02 00:00:00'
             ELSE TIMESTAMP '2024-01-01 00:00:00' END AS _atualizado_em, _action FROM a)"""


@query("cdc_upsert", V.with_views(", " + UPSERT_SQL.format(missing="kept") + "\nSELECT * EXCLUDE (_action) FROM r",
                                  "snapshot_1", "snapshot_2"))
def cdc_upsert(spark, d):
    """CDC-5: MERGE (update changed rows with a stamp, insert new keys, keep the rest)."""
    return C.upsert(_target(spark, d), V.snapshot_2(spark, d), ["c_custkey"], stamp_col="_atualizado_em", stamp=T1).table


@query("cdc_upsert_metrics", V.with_views(", " + UPSERT_SQL.format(missing="kept") + """
SELECT COUNT(*) FILTER (WHERE _action = 'insert') AS num_inserted_rows,
       COUNT(*) FILTER (WHERE _action = 'update') AS num_updated_rows,
       COUNT(*) FILTER (WHERE _action = 'delete') AS num_deleted_rows FROM r""", "snapshot_1", "snapshot_2"))
def cdc_upsert_metrics(spark, d):
    """CDC-5: inserted / updated / deleted counts of one MERGE."""
    return C.upsert(_target(spark, d), V.snapshot_2(spark, d), ["c_custkey"], stamp_col="_atualizado_em", stamp=T1).metrics()


@query("cdc_upsert_rerun", """
SELECT 0::BIGINT AS num_inserted_rows, 0::BIGINT AS num_updated_rows, 0::BIGINT AS num_deleted_rows""")
def cdc_upsert_rerun(spark, d):
    """CDC-5: applying the same source a second time inserts and updates nothing."""
    first = C.upsert(_target(spark, d), V.snapshot_2(spark, d), ["c_custkey"], stamp_col="_atualizado_em", stamp=T1).table
    return C.upsert(first, V.snapshot_2(spark, d), ["c_custkey"], stamp_col="_atualizado_em", stamp=T1).metrics()


@query("cdc_full_sync", V.with_views(", " + UPSERT_SQL.format(missing="delete") + "\nSELECT * EXCLUDE (_action) FROM r WHERE _action <> 'delete'",
                                     "snapshot_1", "snapshot_2"))
def cdc_full_sync(spark, d):
    """CDC-6: MERGE ... WHEN NOT MATCHED BY SOURCE THEN DELETE (full synchronisation)."""
    return C.upsert(_target(spark, d), V.snapshot_2(spark, d), ["c_custkey"], stamp_col="_atualizado_em", stamp=T1,
                    delete_missing=True).table


@query("cdc_upsert_evolve", V.with_views(", " + UPSERT_SQL.format(missing="kept") + """,
s2 AS (SELECT c_custkey, 'tier' || CAST(CAST(FLOOR(c_acctbal) AS BIGINT) % 3 AS VARCHAR) AS c_tier FROM snapshot_2
       WHERE c_custkey % 2 = 0)
SELECT r.* EXCLUDE (_action), CASE WHEN _action IN ('insert', 'update') THEN s2.c_tier END AS c_tier
FROM r LEFT JOIN s2 USING (c_custkey)""", "snapshot_1", "snapshot_2"))
def cdc_upsert_evolve(spark, d):
    """CDC-6: MERGE WITH SCHEMA EVOLUTION: a new source column is added to the target."""
    s = V.snapshot_2(spark, d)
    tier = F.when(F.col("c_custkey") % 2 == 0,
                  F.concat(F.lit("tier"), (F.floor("c_acctbal").cast("bigint") % 3).cast("string")))
    s = s.withColumn("c_tier", tier)
    return C.upsert(_target(spark, d), s, ["c_custkey"], update_when=[c for c in SNAP_COLS if c != "c_custkey"],
                    stamp_col="_atualizado_em", stamp=T1, evolve=True).table


def _scd_target(spark, d):
    return (V.snapshot_1(spark, d).withColumn("valid_from", F.lit(T0).cast("timestamp_ntz"))
            .withColumn("valid_to", F.lit(None).cast("timestamp_ntz")).withColumn("is_current", F.lit(True))
            .withColumn("scd_version", F.lit(1)))


SNAPSHOT_SCD2_SQL = """j AS (SELECT COALESCE(t.c_custkey, s.c_custkey) AS c_custkey, t.c_custkey IS NOT NULL AS in_t,
    s.c_custkey IS NOT NULL AS in_s,
    (t.c_name IS DISTINCT FROM s.c_name OR t.c_nationkey IS DISTINCT FROM s.c_nationkey OR
     t.c_acctbal IS DISTINCT FROM s.c_acctbal OR t.c_mktsegment IS DISTINCT FROM s.c_mktsegment) AS diff,
    t.c_name AS t_name, t.c_nationkey AS t_nation, t.c_acctbal AS t_bal, t.c_mktsegment AS t_seg,
    s.c_name AS s_name, s.c_nationkey AS s_nation, s.c_acctbal AS s_bal, s.c_mktsegment AS s_seg, s.reason
  FROM snapshot_1 t FULL OUTER JOIN ({src}) s ON t.c_custkey = s.c_custkey)
SELECT c_custkey, t_name AS c_name, t_nation AS c_nationkey, t_bal AS c_acctbal, t_seg AS c_mktsegment,
       TIMESTAMP '2024-01-01 00:00:00' AS valid_from,
       CASE WHEN in_s AND in_t AND diff{cond} THEN TIMESTAMP '2024-01-02 00:00:00' END AS valid_to,
       NOT (in_s AND in_t AND diff{cond}) AS is_current, 1 AS scd_version FROM j WHERE in_t
UNION ALL
SELECT c_custkey, s_name, s_nation, s_bal, s_seg, TIMESTAMP '2024-01-02 00:00:00', NULL,
       TRUE, CASE WHEN in_t THEN 2 ELSE 1 END FROM j WHERE in_s AND (NOT in_t OR (diff{cond}))"""


@query("cdc_scd2_snapshot", V.with_views(", " + SNAPSHOT_SCD2_SQL.format(
        src="SELECT *, NULL AS reason FROM snapshot_2", cond=""), "snapshot_1", "snapshot_2"))
def cdc_scd2_snapshot(spark, d):
    """CDC-7 / FLT-4: snapshot-driven SCD2 (close changed rows, open version + 1, new keys version 1)."""
    return C.scd2_compare(_scd_target(spark, d), V.snapshot_2(spark, d), ["c_custkey"],
                          ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], T1)


@query("cdc_corrections", V.with_views(", " + SNAPSHOT_SCD2_SQL.format(
        src="""SELECT *, CASE WHEN c_custkey % 5 = 0 THEN 'ajuste' END AS reason FROM snapshot_2""",
        cond=" AND reason IS NOT NULL"), "snapshot_1", "snapshot_2"))
def cdc_corrections(spark, d):
    """CDC-11: corrections with a reason close the current version and open the next;
    rows without a reason only add new keys."""
    s = V.snapshot_2(spark, d)
    k = F.col("c_custkey")
    corr = s.withColumn("correction_reason", F.when(k % 5 == 0, F.lit("ajuste")))  # balance adjustments carry a reason
    return C.apply_corrections(_scd_target(spark, d), corr, ["c_custkey"],
                               ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], T1)


@query("cdc_apply_changes", V.with_views("""
, ch AS (SELECT *, lower(operacao) AS _change_type FROM clientes_cdc),
l AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cliente_id ORDER BY ts_evento DESC, event_id) AS rn FROM ch)
      WHERE rn = 1)
SELECT cliente_id, nome, uf, segmento, email, cpf, ts_evento FROM l WHERE _change_type <> 'delete'""", "clientes_cdc"))
def cdc_apply_changes(spark, d):
    """CDC-8: _change_type insert/update/delete feed -> current state, order-independent."""
    ch = V.clientes_cdc(spark, d).withColumn("_change_type", F.lower("operacao")).drop("operacao")
    return C.apply_changes(ch, ["cliente_id"], "ts_evento", tiebreak="event_id").drop("event_id")


@query("cdc_high_water", """
WITH hwm AS (SELECT MAX(o_orderdate) AS m FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
       CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'kept' ELSE 'insert' END AS _action
FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' OR o_orderdate > (SELECT m FROM hwm)""")
def cdc_high_water(spark, d):
    """CDC-10: read only rows past the target's high-water mark, then upsert them."""
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
    src = V.table(spark, d, "orders").select(*cols)
    target = src.filter(F.col("o_orderdate") < F.lit(datetime(1999, 1, 1)).cast("timestamp_ntz"))
    delta = C.incremental_since(src, target, "o_orderdate")
    return C.upsert(target, delta, ["o_orderkey"]).actions


@query("cdc_scd3", V.with_views(f""", {STG_SQL},
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cliente_id ORDER BY ts_evento DESC, event_id) AS rk FROM stg)
SELECT a.cliente_id, a.nome, a.uf, a.segmento, a.email, a.cpf, a.operacao, a.ts_evento, a.event_id, b.uf AS previous_uf
FROM r a LEFT JOIN r b ON a.cliente_id = b.cliente_id AND b.rk = 2 WHERE a.rk = 1""", "clientes_cdc"))
def cdc_scd3(spark, d):
    """CDC-12: SCD type 3 (current value plus the previous value of one column)."""
    return C.scd3(clientes_stg(spark, d), ["cliente_id"], "ts_evento", "uf", tiebreak="event_id")


@query("cdc_update_delete", """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority,
       o_totalprice FROM orders WHERE NOT (o_totalprice < 5000)""")
def cdc_update_delete(spark, d):
    """CDC-13: UPDATE ... WHERE and DELETE ... WHERE on a stored table partitioned by year, read back."""
    path = _stored_orders(spark, d)
    ST.update_table(spark, path, "o_orderstatus = 'P'", {"o_orderpriority": "'1-URGENT'"}, ["o_year"])
    ST.delete_from(spark, path, "o_totalprice < 5000", ["o_year"])
    return ST.read_stored(spark, path).select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")


def _stored_orders(spark, d) -> str:
    o = V.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
                                           F.year("o_orderdate").alias("o_year"))
    path = work_path(spark, "stored-orders")
    S.write_partitioned(o, path, ["o_year"])
    return path


@query("cdc_delete_files", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, COUNT(*) FILTER (NOT (o_totalprice < 30000 AND year(o_orderdate) >= 1999)) AS orders_left,
       COUNT(*) FILTER (o_totalprice < 30000 AND year(o_orderdate) >= 1999) > 0 AS rewritten
FROM orders GROUP BY 1 HAVING orders_left > 0""")
def cdc_delete_files(spark, d):
    """CDC-13: a DELETE that hits some years rewrites files of these years alone; the others keep theirs."""
    path = _stored_orders(spark, d)

    def files(flag):
        names = spark.createDataFrame([(f,) for f in ST.data_files(spark, path)], "file string")
        return names.select("file", F.regexp_extract("file", "o_year=(\\d+)", 1).cast("int").alias("o_year"), F.lit(flag).alias("when"))

    before = files("before")
    ST.delete_from(spark, path, "o_totalprice < 30000 AND o_year >= 1999", ["o_year"])
    both = before.unionAll(files("after")).groupBy("o_year", "file").agg(F.count(F.lit(1)).alias("n"))
    changed = both.groupBy("o_year").agg((F.min("n") < 2).alias("rewritten"))
    left = ST.read_stored(spark, path).groupBy("o_year").agg(F.count(F.lit(1)).alias("orders_left"))
    return left.join(changed, "o_year")


@query("win_dedup_latest", """
SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type
  ORDER BY ts DESC NULLS LAST, event_id) AS rn FROM events) WHERE rn = 1""")
def win_dedup_latest(spark, d):
    """WIN-1 / EXP-5: latest row per key by sequence, NULL sequence loses, tiebreak first seen."""
    return dedup_latest(V.table(spark, d, "events"), ["user_id", "event_type"], "ts", "event_id")


@query("jon_point_in_time", V.with_views(f""", {SCD2_SQL}
SELECT e.event_id, e.user_id, e.ts, e.value, h.uf, h.segmento, h.__START_AT AS versao_desde
FROM events e LEFT JOIN scd2 h ON e.user_id = h.cliente_id AND h.__START_AT <= e.ts
  AND (h.__END_AT IS NULL OR e.ts < h.__END_AT)
WHERE e.event_type = 'purchase'""", "clientes_cdc"))
def jon_point_in_time(spark, d):
    """JON-6: each purchase joined to the customer version valid at its time."""
    facts = (V.table(spark, d, "events").filter(F.col("event_type") == "purchase")
             .select("event_id", "user_id", "ts", "value"))
    hist = clientes_scd2(spark, d).withColumnRenamed("cliente_id", "user_id").select("user_id", "uf", "segmento", C.START, C.END)
    res = C.point_in_time(facts, hist, ["user_id"], "ts")
    return res.select("event_id", "user_id", "ts", "value", "uf", "segmento", F.col(C.START).alias("versao_desde"))


@query("cdc_merge_into", V.with_views(", " + UPSERT_SQL.format(missing="kept") + "\nSELECT * EXCLUDE (_action) FROM r",
                                      "snapshot_1", "snapshot_2"))
def cdc_merge_into(spark, d):
    """CDC-5 at scale: MERGE into a key-bucketed table; only touched buckets are read and rewritten."""
    from strata.operators import buckets as B
    path = work_path(spark, "dim-customer-bucketed")
    B.create_bucketed(_target(spark, d), path, ["c_custkey"], 16)
    C.merge_into(spark, path, V.snapshot_2(spark, d), ["c_custkey"], 16, "snap-2", stamp_col="_atualizado_em", stamp=T1)
    return spark.read.parquet(path).drop(B.BUCKET)


@query("cdc_scd2_snapshot_into", V.with_views(", " + SNAPSHOT_SCD2_SQL.format(
        src="SELECT *, NULL AS reason FROM snapshot_2", cond=""), "snapshot_1", "snapshot_2"))
def cdc_scd2_snapshot_into(spark, d):
    """CDC-7 at scale: snapshot SCD2 on a key-bucketed table, touched buckets only."""
    from strata.operators import buckets as B
    path = work_path(spark, "dim-customer-scd2")
    B.create_bucketed(_scd_target(spark, d), path, ["c_custkey"], 16)
    C.scd2_snapshot_into(spark, path, V.snapshot_2(spark, d), ["c_custkey"],
                         ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], T1, 16, "snap-2")
    return spark.read.parquet(path).drop(B.BUCKET)
