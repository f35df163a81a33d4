"""Streaming queries: event-time windows, watermark drains, lambda merge, stream dedup,
hybrid union, incremental CDC with foreachBatch, and the full medallion run."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from strata.functions.money import money_sum
from strata.operators import quality as Q
from strata.operators.sinks import write_partitioned
from strata.plans import medallion as MD
from strata.plans import views as V
from strata.plans.q_cdc import CDC_RULES, SCD2_SQL, STG_SQL, CDC_COLS_SQL
from strata.plans.q_gold import MONTHLY_SQL, SLO_RULES
from strata.plans.registry import query
from strata.session import path_exists, work_path
from strata.sources.landing import TS_FORMAT, land_by_day
from strata.streaming import cdc_stream as CS
from strata.streaming import windows as W
from strata.streaming.ingest import run_foreach_batch

EVENTS_DDL = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _mean4_sql(col: str = "value") -> str:
    """Exact half-up mean to 4 decimals from integer cents (oracle side)."""
    cents = f"CAST(ROUND({col} * 100) AS BIGINT)"
    return f"CAST((200 * SUM({cents}) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 10000"


@query("str_hourly", f"""
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, user_id,
       {_mean4_sql()} AS avg_value, COUNT(*) AS readings FROM events GROUP BY 1, 2, 3""")
def str_hourly(spark, d):
    """STR-1: 1-hour tumbling window, mean value per device (user)."""
    e = V.table(spark, d, "events")
    return W.tumbling(e, "ts", "1 hour", ["user_id"], [W.exact_mean("value").alias("avg_value"),
                                                        F.count(F.lit(1)).alias("readings")])


@query("str_15min", """
SELECT time_bucket(INTERVAL '15 minutes', ts) AS window_start, time_bucket(INTERVAL '15 minutes', ts) + INTERVAL 15 MINUTE AS window_end,
       COUNT(*) AS eventos FROM events GROUP BY 1, 2""")
def str_15min(spark, d):
    """STR-2: 15-minute event counts."""
    return W.tumbling(V.table(spark, d, "events"), "ts", "15 minutes", [], [F.count(F.lit(1)).alias("eventos")])


@query("str_5min", """
SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, time_bucket(INTERVAL '5 minutes', ts) + INTERVAL 5 MINUTE AS window_end,
       event_type, COUNT(*) AS eventos, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2, 3""")
def str_5min(spark, d):
    """STR-3: 5-minute buckets per event type."""
    return W.tumbling(V.table(spark, d, "events"), "ts", "5 minutes", ["event_type"],
                      [F.count(F.lit(1)).alias("eventos"), money_sum("value").alias("total")])


REPLAY_TAIL = timedelta(minutes=30)


def _by_week(spark, df, name, run, replay: bool = False) -> None:
    """Lands ``df`` once, in folders by calendar week, and hands the stream one folder after the other: ``run(stream)`` after each.

    All files of a week are one run's input, so event time advances from run to run whatever the
    months. The source is scanned once; a week's folder joins the stream's input by being renamed, so a long
    or a crowded week is written by as many tasks as it needs. Only the weeks' first days
    reach the driver. ``replay`` lands each row twice in its week, and the last half hour of a
    week once more with the next one.
    """
    path, staged = work_path(spark, name), work_path(spark, f"{name}-staged")
    # Rows without a time come first.
    week = F.coalesce(F.date_trunc("week", F.col("ts")), F.lit(datetime(1970, 1, 5))).cast("date")
    if replay:
        following = F.date_add(week, 7)
        tail = F.col("ts") >= following.cast("timestamp_ntz") - F.expr(f"INTERVAL {int(REPLAY_TAIL.total_seconds())} SECOND")
        landed = df.select("*", F.explode(F.when(tail, F.array(week, week, following)).otherwise(F.array(week, week))).alias("week"))
    else:
        landed = df.select("*", week.alias("week"))
    write_partitioned(landed, staged, ["week"])
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs.mkdirs(at(path))
    starts = sorted(n for n in (f.getPath().getName() for f in fs.listStatus(at(staged))) if n.startswith("week="))
    if not starts:
        df.limit(0).write.parquet(f"{path}/none")
        run(spark.readStream.schema(EVENTS_DDL).parquet(f"{path}/*"))
    for start in starts:
        fs.rename(at(f"{staged}/{start}"), at(f"{path}/{start.split('=')[1]}"))
        run(spark.readStream.schema(EVENTS_DDL).parquet(f"{path}/*"))


def _drain(df, target, ckpt, mode="append"):
    q = (df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start(target))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


@query("str_stream_hourly", """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type,
       COUNT(*) AS eventos FROM events GROUP BY 1, 2, 3
HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTE""")
def str_stream_hourly(spark, d):
    """STR-4: streaming hourly counts, append mode with a 10-minute watermark (closed windows only)."""
    e = V.table(spark, d, "events").select(*[c.split()[0] for c in EVENTS_DDL.split(", ")])
    target, ckpt = work_path(spark, "stream-hourly"), work_path(spark, "ckpt-stream-hourly")
    _by_week(spark, e, "landing-weekly", lambda s: _drain(
        W.streaming_windows(s, "ts", "1 hour", "10 minutes", ["event_type"], [F.count(F.lit(1)).alias("eventos")]), target, ckpt))
    out = spark.read.parquet(target)
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "event_type", "eventos")


@query("str_lambda", """
WITH batch AS (SELECT date_trunc('hour', ts) AS window_start, COUNT(*) AS eventos, 'batch' AS layer FROM events
               WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1),
speed AS (SELECT date_trunc('hour', ts) AS window_start, COUNT(*) AS eventos, 'speed' AS layer FROM events
          WHERE ts >= TIMESTAMP '2024-01-19' GROUP BY 1
          HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTE)
SELECT * FROM batch UNION ALL SELECT * FROM speed WHERE window_start NOT IN (SELECT window_start FROM batch)""")
def str_lambda(spark, d):
    """STR-5: batch layer wins, the streaming (speed) layer fills the windows after it."""
    e = V.table(spark, d, "events").select(*[c.split()[0] for c in EVENTS_DDL.split(", ")])
    cut, speed_from = F.lit(datetime(2024, 1, 20)).cast("timestamp_ntz"), F.lit(datetime(2024, 1, 19)).cast("timestamp_ntz")
    batch = (W.tumbling(e.filter(F.col("ts") < cut), "ts", "1 hour", [], [F.count(F.lit(1)).alias("eventos")])
             .select("window_start", "eventos", F.lit("batch").alias("layer")))
    target, ckpt = work_path(spark, "speed-hourly"), work_path(spark, "ckpt-speed")
    _by_week(spark, e.filter(F.col("ts") >= speed_from), "landing-speed", lambda s: _drain(
        W.streaming_windows(s, "ts", "1 hour", "10 minutes", [], [F.count(F.lit(1)).alias("eventos")]), target, ckpt))
    speed = spark.read.parquet(target).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "eventos",
                                              F.lit("speed").alias("layer"))
    return W.speed_batch_merge(batch, speed, ["window_start"])


@query("str_dedup", "SELECT event_id, ts, user_id, event_type, value FROM events")
def str_dedup(spark, d):
    """STR-6: replayed events removed by a streaming dedup within a 1-hour watermark: every replay
    comes before the watermark passes it, so the state drops it, not lateness."""
    e = V.table(spark, d, "events").select(*[c.split()[0] for c in EVENTS_DDL.split(", ")])
    target, ckpt = work_path(spark, "stream-dedup"), work_path(spark, "ckpt-dedup")
    _by_week(spark, e, "landing-replay", lambda s: _drain(
        W.dedup_stream(s, "ts", ["event_id"], "1 hour").select("event_id", "ts", "user_id", "event_type", "value"), target, ckpt),
        replay=True)
    return spark.read.parquet(target)


@query("set_hybrid_union", "SELECT event_id, ts, user_id, event_type, value FROM events")
def set_hybrid_union(spark, d):
    """SET-5: streamed recent rows and batch history in one schema (unionByName)."""
    e = V.table(spark, d, "events").select(*[c.split()[0] for c in EVENTS_DDL.split(", ")])
    cut = F.lit(datetime(2024, 1, 20)).cast("timestamp_ntz")
    target, ckpt = work_path(spark, "hybrid-stream"), work_path(spark, "ckpt-hybrid")
    _by_week(spark, e.filter(F.col("ts") >= cut), "landing-hybrid", lambda s: _drain(s.drop("props"), target, ckpt))
    hist = e.filter(F.col("ts") < cut).select("event_id", "ts", "user_id", "event_type", "value")
    return hist.unionByName(spark.read.parquet(target).select("event_id", "ts", "user_id", "event_type", "value"))


# ------------------------------------------------------------------ incremental CDC

CDC_DDL = ("cliente_id BIGINT, nome STRING, uf STRING, segmento STRING, email STRING, cpf STRING, operacao STRING, "
           "ts_evento TIMESTAMP_NTZ, event_id BIGINT")


def _cdc_in_thirds(spark, d, name, run) -> None:
    """The customer feed lands in thirds by event_id % 3, and ``run(stream)`` is called after each:
    every third spans the whole period, so the later ones are full of late events."""
    feed = V.clientes_cdc(spark, d)
    landing = work_path(spark, name)
    for k in range(3):
        third = F.coalesce(F.pmod("event_id", F.lit(3)), F.lit(0)) == k
        feed.filter(third).write.mode("append").option("timestampNTZFormat", TS_FORMAT).json(landing)
        run(Q.expect(spark.readStream.schema(CDC_DDL).option("timestampNTZFormat", TS_FORMAT).json(landing), CDC_RULES))


@query("cdc_stream_scd1", V.with_views(f""", {STG_SQL},
latest AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cliente_id ORDER BY ts_evento DESC NULLS LAST, event_id)
           AS rn FROM stg) WHERE rn = 1)
SELECT {CDC_COLS_SQL} FROM latest WHERE operacao <> 'DELETE'""", "clientes_cdc"))
def cdc_stream_scd1(spark, d):
    """CDC-9: SCD1 applied micro-batch by micro-batch into bucketed state (tombstones kept)."""
    state = work_path(spark, "state-scd1")
    fold, ckpt = CS.scd1_fold(["cliente_id"], "ts_evento", "event_id", state, 8), work_path(spark, "ckpt-cdc1")
    _cdc_in_thirds(spark, d, "landing-cdc1", lambda s: run_foreach_batch(s, fold, ckpt))
    return CS.scd1_current(spark, state, "operacao = 'DELETE'", drop=["operacao", "event_id"])


@query("cdc_stream_scd1_state", V.with_views(f""", {STG_SQL},
latest AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cliente_id ORDER BY ts_evento DESC NULLS LAST, event_id)
           AS rn FROM stg) WHERE rn = 1)
SELECT {CDC_COLS_SQL} FROM latest WHERE operacao <> 'DELETE'""", "clientes_cdc"))
def cdc_stream_scd1_state(spark, d):
    """CDC-9: SCD1 kept in the streaming state store; only changed keys merged per micro-batch."""
    target, ckpt = work_path(spark, "current-scd1"), work_path(spark, "ckpt-cdc1s")
    _cdc_in_thirds(spark, d, "landing-cdc1s", lambda s: CS.scd1_stateful(
        s, ["cliente_id"], "ts_evento", "event_id", target, 8, ckpt))
    return CS.scd1_current(spark, target, "operacao = 'DELETE'", drop=["operacao", "event_id"])


@query("cdc_stream_scd2", V.with_views(f", {SCD2_SQL}\nSELECT * FROM scd2", "clientes_cdc"))
def cdc_stream_scd2(spark, d):
    """CDC-9: SCD2 history maintained incrementally; late events split the right interval."""
    state = work_path(spark, "state-scd2")
    fold, ckpt = CS.scd2_fold(["cliente_id"], "ts_evento", "event_id", state, 8), work_path(spark, "ckpt-cdc2")
    _cdc_in_thirds(spark, d, "landing-cdc2", lambda s: run_foreach_batch(s, fold, ckpt))
    return CS.scd2_history(spark, state, ["cliente_id"], "ts_evento", "operacao = 'DELETE'", drop=["operacao", "event_id"])


@query("str_medallion_run", MONTHLY_SQL.replace("valor >= 5", "valor >= 1"))
def str_medallion_run(spark, d):
    """STR-7: bronze -> silver (expectations, SCD1) -> gate at 5 % of dropped rows -> gold in one triggered run."""
    landing = land_by_day(V.table(spark, d, "events"), "ts", work_path(spark, "landing-medallion"), timestampNTZFormat=TS_FORMAT)
    res = MD.run(spark, landing, work_path(spark, "lakehouse"), "run-1", datetime(2024, 2, 1), rules=SLO_RULES,
                 gate_mode="dropped_rows")
    return spark.read.parquet(res.gold)


@query("str_medallion_rejected", """
WITH g AS (SELECT ROUND(COUNT(*) FILTER (WHERE NOT COALESCE(value >= 5, FALSE)) / GREATEST(COUNT(*), 1), 6) AS rate FROM events)
SELECT run, 'ALERTA' AS status, g.rate, FALSE AS gold_written FROM g, (VALUES (1), (2)) t(run)""")
def str_medallion_rejected(spark, d):
    """STR-7 / QLT-4: with the stricter rule over 5 % of the rows are dropped; the run stops before
    gold, and a rerun without new files still finds the uncertified batches and stops again."""
    landing = land_by_day(V.table(spark, d, "events"), "ts", work_path(spark, "landing-rejected"), timestampNTZFormat=TS_FORMAT)
    root, rows = work_path(spark, "lakehouse-rejected"), []
    for run in (1, 2):
        try:
            MD.run(spark, landing, root, f"run-{run}", datetime(2024, 2, 1), gate_mode="dropped_rows")
            rows.append((run, Q.STATUS_OK, 0.0, True))
        except MD.GateRejected as e:
            rows.append((run, e.status, e.rate, path_exists(spark, e.gold)))
    return spark.createDataFrame(rows, "run int, status string, rate double, gold_written boolean")
