"""Ingestion and sink queries: streaming bronze, file metadata, rescue, schema
evolution, nested JSON, full rebuild, COPY INTO, typed batch reads, broker
payloads, daily loads, partition discovery, appends, overwrites, refreshes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.parsing import parse_month_br
from strata.functions.money import cents
from strata.operators import aggregates as A
from strata.operators import sinks as S
from strata.operators.quality import DROP, WARN, Rule, expect
from strata.plans import views as V
from strata.plans.q_gold import MONTHLY_SQL, silver_obs
from strata.plans.registry import query
from strata.session import work_path
from strata.sources import files as SF
from strata.sources import rescue as R
from strata.sources.landing import TS_FORMAT, land, land_by_day
from strata.streaming.ingest import ingest_available_now

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
    T.StructField("day", T.StringType()),
])
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
INGESTED_AT = datetime(2024, 2, 1)


def _bronze_events(spark, d, runs: int = 1):
    """Land events as JSON (one folder per day), ingest with availableNow ``runs`` times."""
    landing = land_by_day(V.table(spark, d, "events"), "ts", work_path(spark, "landing-events"),
                          timestampNTZFormat=TS_FORMAT)
    target, ckpt = work_path(spark, "bronze-events"), work_path(spark, "ckpt-bronze-events")
    for _ in range(runs):
        ingest_available_now(spark, landing, "json", EVENT_SCHEMA, target, ckpt, ingested_at=INGESTED_AT,
                             timestampNTZFormat=TS_FORMAT)
    return spark.read.parquet(target)


@query("src_stream_events", "SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events")
def src_stream_events(spark, d):
    """SRC-1 / SNK-1: incremental JSON landing -> bronze parquet via a checkpointed stream."""
    return _bronze_events(spark, d).select(*EVENT_COLS, "day")


@query("src_file_metadata", """
SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS n_traced, COUNT(*) AS n_rows,
       TIMESTAMP '2024-02-01 00:00:00' AS ingerido_em FROM events GROUP BY 1""")
def src_file_metadata(spark, d):
    """SRC-2: audit columns (source file, file time, ingestion time): rows of a day whose source
    file lies in that day's landing folder."""
    b = _bronze_events(spark, d)
    traced = F.contains(F.col(SF.FILE_COL), F.concat(F.lit("/day="), F.col("day"), F.lit("/")))
    return (b.groupBy("day").agg(F.count_if(traced).alias("n_traced"), F.count(F.lit(1)).alias("n_rows"),
                                 F.max(F.col(SF.INGESTED_COL).cast("timestamp_ntz")).alias("ingerido_em")))


@query("src_available_now_twice", "SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS n_rows FROM events GROUP BY 1")
def src_available_now_twice(spark, d):
    """SRC-6: two availableNow runs on the same checkpoint load every file exactly once."""
    return _bronze_events(spark, d, runs=2).groupBy("day").agg(F.count(F.lit(1)).alias("n_rows"))


FROZEN = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                       T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])


def _raw_json_events(spark, d):
    """JSON text per event with an extra object field, an extra ts field on every third
    event and a wrongly typed value on every 50th."""
    return _raw_json_events_with_id(spark, d).select("text")


@query("src_rescue", """
SELECT event_id, user_id, event_type, CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS value,
  'extra' || CASE WHEN event_id % 3 = 0 THEN ',ts' ELSE '' END || CASE WHEN event_id % 50 = 0 THEN ',value' ELSE '' END AS rescued_keys,
  CASE WHEN event_id % 50 = 0 THEN 'abc' END AS rescued_value, FALSE AS _corrupt FROM events""")
def src_rescue(spark, d):
    """SRC-3: frozen schema; unknown fields and type mismatches kept in _rescued_data."""
    r = R.read_rescued(_raw_json_events(spark, d), "text", FROZEN, keep_map=True)
    m = F.col("_rescued_map")
    return r.select("event_id", "user_id", "event_type", "value",
                    F.array_join(F.array_sort(F.map_keys(m)), ",").alias("rescued_keys"),
                    m["value"].alias("rescued_value"), R.CORRUPT)


NESTED = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ctx", T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType())]))])


@query("src_rescue_stream", """
SELECT event_id, CASE WHEN event_id % 50 = 0 THEN NULL ELSE user_id END AS user_id, event_type,
  NULLIF(concat_ws(',', CASE WHEN event_id % 3 = 0 THEN 'ctx.extra' END, CASE WHEN event_id % 50 = 0 THEN 'ctx.user_id' END), '')
    AS rescued_keys FROM events""")
def src_rescue_stream(spark, d):
    """SRC-1 / SRC-3: a stream with a frozen schema; surplus and mismatched fields inside a struct are rescued."""
    e = V.table(spark, d, "events")
    user = F.when(F.col("event_id") % 50 == 0, F.lit('"abc"')).otherwise(F.col("user_id").cast("string"))
    extra = F.when(F.col("event_id") % 3 == 0, F.lit(',"extra":1')).otherwise(F.lit(""))
    text = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"ctx":{"user_id":'), user,
                    F.lit(',"event_type":"'), "event_type", F.lit('"'), extra, F.lit("}}"))
    landing = land(e.select(text.alias("value")), work_path(spark, "landing-rescue"), "text")
    target, ckpt = work_path(spark, "bronze-rescue"), work_path(spark, "ckpt-rescue")
    ingest_available_now(spark, landing, "text", "value string", target, ckpt, ingested_at=INGESTED_AT,
                         transform=lambda s: R.read_rescued(s, "value", NESTED))
    return spark.read.parquet(target).select("event_id", "ctx.user_id", "ctx.event_type", R.rescued_keys().alias("rescued_keys"))


@query("src_evolve", """
SELECT event_id, user_id, event_type, value, CASE WHEN day(ts) > 15 THEN props END AS props FROM events""")
def src_evolve(spark, d):
    """SRC-4 addNewColumns: the first run with a new column stops with SchemaEvolved and
    stores the wider schema; the rerun continues and older rows read NULL."""
    e = V.table(spark, d, "events")
    landing, schema_path = work_path(spark, "landing-evolve"), work_path(spark, "schema-evolve")
    target, ckpt = work_path(spark, "bronze-evolve"), work_path(spark, "ckpt-evolve")
    gen1 = e.filter(F.dayofmonth("ts") <= 15).select("event_id", "user_id", "event_type", "value",
                                                     F.lit("g1").alias("gen"))
    gen2 = e.filter(F.dayofmonth("ts") > 15).select("event_id", "user_id", "event_type", "value", "props",
                                                    F.lit("g2").alias("gen"))
    land(gen1, landing + "/gen=g1", "json")
    schema = R.evolve_schema(spark, landing, schema_path)
    ingest_available_now(spark, landing, "json", schema, target, ckpt, mtime=False, ingested_at=INGESTED_AT)
    land(gen2, landing + "/gen=g2", "json")
    try:
        R.evolve_schema(spark, landing, schema_path)
        raise AssertionError("new column not detected")
    except R.SchemaEvolved:
        pass
    schema = R.evolve_schema(spark, landing, schema_path)  # the rerun starts with the widened schema
    ingest_available_now(spark, landing, "json", schema, target, ckpt, mtime=False, ingested_at=INGESTED_AT)
    return SF.read_target(spark, target).select("event_id", "user_id", "event_type", "value", "props")


@query("src_schema_state", """
SELECT 'event_id' AS campo, 'bigint' AS tipo, COUNT(event_id) AS preenchidos FROM events
UNION ALL SELECT 'ctx.user_id', 'bigint', COUNT(user_id) FROM events
UNION ALL SELECT 'ctx.event_type', 'string', COUNT(event_type) FROM events
UNION ALL SELECT 'value', 'double', COUNT(value) FROM events
UNION ALL SELECT 'ctx.nota', 'string', COUNT(*) FROM events WHERE event_id = (SELECT MAX(event_id) FROM events)""")
def src_schema_state(spark, d):
    """SRC-4 / SRC-5: three drops of JSON with a schema kept across them: each run opens the files of its own drop
    only, and a field that one record of the last drop has is found. Counts per field, read with that schema."""
    e = V.table(spark, d, "events")
    landing, state = work_path(spark, "landing-state"), work_path(spark, "schema-state")
    note = F.when(F.col("event_id") == e.agg(F.max("event_id")).first()[0], F.lit("fim"))
    rows = e.select("event_id", "value", F.struct("user_id", "event_type", note.alias("nota")).alias("ctx"),
                    F.coalesce(F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)), F.lit(2)).alias("drop"))
    for n in range(3):
        land(rows.filter(F.col("drop") == n).drop("drop"), f"{landing}/{n}", "json")
        schema = SF.infer_json_schema(spark, f"{landing}/*", state)
    read = spark.read.schema(schema).json(f"{landing}/*")
    paths = [(f.name, f.dataType) for f in schema.fields if f.name != "ctx"] + [(f"ctx.{f.name}", f.dataType) for f in schema["ctx"].dataType.fields]
    counts = read.agg(*[F.count(p).alias(p.replace(".", "__")) for p, _ in paths])
    rows = [F.struct(F.lit(p).alias("campo"), F.lit(t.simpleString()).alias("tipo"), F.col(p.replace(".", "__")).alias("preenchidos")) for p, t in paths]
    return counts.select(F.inline(F.array(*rows)))


@query("src_read_layer", """
SELECT CAST(ts AS DATE) AS dia, event_type, COUNT(*) AS eventos, 'lote' AS leitura FROM events GROUP BY 1, 2
UNION ALL SELECT CAST(ts AS DATE), event_type, COUNT(*), 'fluxo' FROM events GROUP BY 1, 2""")
def src_read_layer(spark, d):
    """SRC-12: one bronze table read as a batch and as a stream (into a silver table): both see every row."""
    from strata.streaming.ingest import append_stream
    bronze, silver = work_path(spark, "layer-bronze"), work_path(spark, "layer-silver")
    S.append_batch(V.table(spark, d, "events").select("event_id", "ts", "event_type"), bronze)
    append_stream(SF.read_layer(spark, bronze, stream=True), silver, work_path(spark, "ckpt-layer")).awaitTermination()

    def daily(df, name):
        return df.groupBy(F.to_date("ts").alias("dia"), "event_type").agg(F.count(F.lit(1)).alias("eventos")).withColumn("leitura", F.lit(name))

    return daily(SF.read_layer(spark, bronze), "lote").unionByName(daily(SF.read_layer(spark, silver), "fluxo"))


def _envelopes(spark, d):
    """Market-expectation envelopes (nested OData payload) from lineitem rows."""
    li = V.table(spark, d, "lineitem")
    k = F.col("l_partkey") + F.col("l_linenumber")
    item = F.struct(
        F.lit("IPCA").alias("Indicador"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("Data"),
        F.when(k % 11 == 0, F.lit("13/2001")).otherwise(F.date_format("l_shipdate", "MM/yyyy")).alias("DataReferencia"),
        F.col("l_extendedprice").alias("Media"),
        F.when(k % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("l_quantity")).alias("Mediana"),
        F.col("l_linenumber").alias("numeroRespondentes"))
    env = li.select(F.date_format("l_shipdate", "yyyy-MM").alias("mes"),
                    F.lit("2024-02-01T00:00:00").alias("coletado_em"), F.lit("ExpectativaMercadoMensais").alias("endpoint"),
                    F.struct(F.lit("$metadata#_odata").alias("@odata.context"), F.array(item).alias("value")).alias("payload"))
    return env


# Output column -> (payload field, tolerant parser). The payload's field names.
EXP_FIELDS = {
    "indicador": ("Indicador", lambda c: c),
    "data_boletim": ("Data", F.try_to_date),
    "mes_referencia": ("DataReferencia", parse_month_br),
    "media": ("Media", lambda c: c.try_cast("double")),
    "mediana": ("Mediana", lambda c: c.try_cast("double")),
    "respondentes": ("numeroRespondentes", lambda c: c.try_cast("int")),
}
EXP_RULES = [Rule("mediana_valida", "mediana IS NOT NULL", DROP), Rule("referencia_valida", "mes_referencia IS NOT NULL", WARN)]


@query("src_nested_json", """
SELECT 'IPCA' AS indicador, CAST(l_shipdate AS DATE) AS data_boletim,
  CASE WHEN (l_partkey + l_linenumber) % 11 = 0 THEN NULL ELSE CAST(date_trunc('month', l_shipdate) AS DATE) END AS mes_referencia,
  l_extendedprice AS media, l_quantity AS mediana, l_linenumber AS respondentes
FROM lineitem WHERE (l_partkey + l_linenumber) % 17 <> 0""")
def src_nested_json(spark, d):
    """SRC-5: nested JSON with typed inference, streamed, flattened with explode, DROP/WARN rules."""
    landing = land(_envelopes(spark, d), work_path(spark, "landing-expect"), "json", partition_by=["mes"])
    schema = SF.infer_json_schema(spark, landing, work_path(spark, "schema-expect"))
    target, ckpt = work_path(spark, "bronze-expect"), work_path(spark, "ckpt-expect")
    ingest_available_now(spark, landing, "json", schema, target, ckpt, mtime=False, ingested_at=INGESTED_AT)
    items = SF.read_target(spark, target).select(F.inline("payload.value"))
    return expect(items.select(*[parse(F.col(field)).alias(name) for name, (field, parse) in EXP_FIELDS.items()]), EXP_RULES)


@query("src_full_rebuild", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def src_full_rebuild(spark, d):
    """SRC-7: CTAS from CSV files, recreated on each run (run twice: same table)."""
    landing = land(V.table(spark, d, "nation"), work_path(spark, "landing-csv"), "csv", header=True)
    target = work_path(spark, "ctas-nation")
    SF.full_rebuild(spark, landing, "csv", target, header=True, inferSchema=True)
    return SF.full_rebuild(spark, landing, "csv", target, header=True, inferSchema=True)


def _copy_into(spark, d):
    o = V.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                                           F.date_format("o_orderdate", "yyyy").alias("ano"))
    landing = land(o, work_path(spark, "landing-orders"), "parquet", partition_by=["ano"])
    target = work_path(spark, "copy-orders")
    n1 = SF.load_new_files(spark, landing, "parquet", target)
    n2 = SF.load_new_files(spark, landing, "parquet", target)
    return target, n1, n2


@query("src_copy_twice", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def src_copy_twice(spark, d):
    """SRC-8: COPY INTO twice; the table holds every row once."""
    target, _, _ = _copy_into(spark, d)
    return SF.read_target(spark, target).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@query("src_copy_metrics", "SELECT 1 AS run, COUNT(*) AS num_inserted_rows FROM orders UNION ALL SELECT 2, 0")
def src_copy_metrics(spark, d):
    """SRC-8: inserted rows per COPY INTO run (second run 0)."""
    _, n1, n2 = _copy_into(spark, d)
    return spark.createDataFrame([(1, n1), (2, n2)], "run int, num_inserted_rows bigint")


CUSTOMER_DDL = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


@query("src_batch_csv", "SELECT * FROM customer")
def src_batch_csv(spark, d):
    """SRC-9: CSV batch read with an explicit schema (no inference pass)."""
    landing = land(V.table(spark, d, "customer"), work_path(spark, "landing-customer"), "csv", header=True)
    return SF.read_batch(spark, landing, "csv", CUSTOMER_DDL, header=True)


@query("src_parse_events", "SELECT event_id, ts, user_id, event_type, value, props, 'events-topic' AS _topic, 'broker' AS _source FROM events")
def src_parse_events(spark, d):
    """SRC-10: broker payloads (binary value) parsed with from_json and flattened."""
    e = V.table(spark, d, "events")
    rec = SF.to_broker_records(e, F.col("user_id"), "events-topic")
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    return SF.parse_event_value(rec, schema, "broker").drop("_partition", "_offset")


@query("src_daily_hash", """
SELECT event_id, user_id, event_type, CASE WHEN event_id % 4 = 0 THEN NULL ELSE props END AS props, '2024-01-10' AS day, 'app' AS _source_system, 2024 AS _year, 1 AS _month,
  md5(concat_ws('|', COALESCE(CAST(event_id AS VARCHAR), chr(0)), COALESCE(CAST(user_id AS VARCHAR), chr(0)),
      COALESCE(event_type, chr(0)), COALESCE(CASE WHEN event_id % 4 = 0 THEN NULL ELSE props END, chr(0)))) AS _content_hash
FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'""")
def src_daily_hash(spark, d):
    """SRC-11: one day's partition + metadata + partition columns + NULL-aware content hash."""
    e = V.table(spark, d, "events").select("event_id", "user_id", "event_type",
                                           F.when(F.col("event_id") % 4 == 0, F.lit(None)).otherwise(F.col("props")).alias("props"),
                                           F.date_format("ts", "yyyy-MM-dd").alias("day"))
    landing = land(e, work_path(spark, "landing-daily"), "parquet", partition_by=["day"])
    out = SF.load_daily(spark, landing, "2024-01-10", "app", ["event_id", "user_id", "event_type", "props"])
    return out.select("event_id", "user_id", "event_type", "props", F.col("day").cast("string").alias("day"),
                      "_source_system", "_year", "_month", "_content_hash")


@query("src_partition_dirs", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag AS serie FROM lineitem")
def src_partition_dirs(spark, d):
    """SRC-13: hive-style folders (serie=<code>) discovered as a column."""
    li = V.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_returnflag").alias("serie"))
    landing = land(li, work_path(spark, "landing-series"), "parquet", partition_by=["serie"])
    return spark.read.option("basePath", landing).parquet(landing).select("l_orderkey", "l_linenumber", "l_quantity", "serie")


# ------------------------------------------------------------------ sinks

@query("snk_append", "SELECT event_id, ts, user_id, event_type, value FROM events")
def snk_append(spark, d):
    """SNK-2: append-only history in two loads (first half of the month, then the rest)."""
    e = V.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    target = work_path(spark, "append-events")
    S.append_batch(e.filter(F.dayofmonth("ts") <= 15), target)
    S.append_batch(e.filter(F.dayofmonth("ts") > 15), target)
    return spark.read.parquet(target)


@query("snk_overwrite", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def snk_overwrite(spark, d):
    """SNK-3: full refresh replaces the previous content."""
    o = V.table(spark, d, "orders")
    target = work_path(spark, "overwrite-orders")
    S.overwrite(o.select("o_orderkey", "o_totalprice"), target)
    S.overwrite(o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice"), target)
    return spark.read.parquet(target)


@query("snk_refresh_groups", """
WITH now AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS mes, CAST(ROUND(l_extendedprice * 100) AS BIGINT) *
  CASE WHEN year(l_shipdate) = 1997 AND month(l_shipdate) = 3 THEN -1 WHEN year(l_shipdate) = 1998 AND l_linenumber = 1 THEN 2 ELSE 1 END AS cents FROM lineitem)
SELECT mes, COUNT(*) AS linhas, CAST(SUM(cents) AS BIGINT) AS total, MIN(cents) AS menor, MAX(cents) AS maior FROM now WHERE cents > 0 GROUP BY mes""")
def snk_refresh_groups(spark, d):
    """SNK-4: a correction empties one month and changes twelve others of the stored gold table; only these are
    refreshed (the rest keep their files) and the table equals a full recompute."""
    line = V.table(spark, d, "lineitem").select("l_linenumber", F.col("l_shipdate").alias("dia"), A.month_of("l_shipdate").alias("mes"),
                                                cents(F.col("l_extendedprice")).alias("cents"))

    def gold(df):
        return (df.filter("cents > 0").groupBy("mes").agg(F.count(F.lit(1)).alias("linhas"), F.sum("cents").alias("total"),
                                                         F.min("cents").alias("menor"), F.max("cents").alias("maior")))

    target = work_path(spark, "gold-monthly")
    S.write_partitioned(gold(line), target, ["mes"], compression="snappy")
    factor = F.when((F.year("dia") == 1997) & (F.month("dia") == 3), -1).when((F.year("dia") == 1998) & (F.col("l_linenumber") == 1), 2).otherwise(1)
    touched = line.filter(factor != 1).select("mes").distinct()
    now = line.withColumn("cents", F.col("cents") * factor)
    S.refresh_partitions(spark, target, now.join(touched, "mes", "left_semi"), ["mes"], gold, touched)
    return spark.read.parquet(target).select(F.col("mes").cast("date").alias("mes"), "linhas", "total", "menor", "maior")


@query("snk_partitioned", "SELECT o_orderkey, o_totalprice, o_orderstatus, strftime(o_orderdate, '%Y') AS ano FROM orders")
def snk_partitioned(spark, d):
    """SNK-5: partitioned parquet with zstd compression, rows clustered per partition."""
    o = V.table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus",
                                           F.date_format("o_orderdate", "yyyy").alias("ano"))
    target = work_path(spark, "partitioned-orders")
    S.write_partitioned(o, target, ["ano", "o_orderstatus"], compression="zstd")
    return spark.read.parquet(target).select("o_orderkey", "o_totalprice", "o_orderstatus",
                                             F.col("ano").cast("string").alias("ano"))


@query("snk_append_stream", """
SELECT event_id, ts, event_type, value, strftime(ts, '%Y-%m-%d') AS day FROM events""")
def snk_append_stream(spark, d):
    """SNK-1: stream appended with a checkpoint into a day-partitioned parquet table."""
    from strata.streaming.ingest import append_stream, read_landing_stream
    landing = land_by_day(V.table(spark, d, "events"), "ts", work_path(spark, "landing-append"),
                          timestampNTZFormat=TS_FORMAT)
    target, ckpt = work_path(spark, "bronze-append-part"), work_path(spark, "ckpt-append-part")
    src = read_landing_stream(spark, landing, "json", EVENT_SCHEMA, ingested_at=INGESTED_AT, timestampNTZFormat=TS_FORMAT)
    q = append_stream(src.select("event_id", "ts", "event_type", "value", "day"), target, ckpt, partition_by=["day"])
    q.awaitTermination()
    return spark.read.parquet(target).select("event_id", "ts", "event_type", "value", F.col("day").cast("string").alias("day"))


@query("agg_per_file", """
SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS n_rows, COUNT(*) AS n_rescued,
       COUNT(*) FILTER (WHERE event_id % 50 = 0) AS n_type_errors,
       MAX('extra' || CASE WHEN event_id % 3 = 0 THEN ',ts' ELSE '' END
                   || CASE WHEN event_id % 50 = 0 THEN ',value' ELSE '' END) AS max_rescued_keys
FROM events GROUP BY 1""")
def agg_per_file(spark, d):
    """AGG-11: rows and rescued-data metrics per landed file, rolled up to the landing day
    (a day may have several files)."""
    raw = _raw_json_events_with_id(spark, d, with_day=True).select("day", "text")
    landing = land(raw, work_path(spark, "landing-text"), "text", partition_by=["day"])
    files = spark.read.text(landing).select(F.col("value").alias("text"), "day", F.col("_metadata.file_path").alias("f"))
    r = R.read_rescued(files, "text", FROZEN)
    m = F.from_json(F.col(R.RESCUED), T.MapType(T.StringType(), T.StringType()))
    per_file = (r.groupBy("f", "day")
                 .agg(F.count(F.lit(1)).alias("n_rows"), F.count(R.RESCUED).alias("n_rescued"),
                      F.count_if(m["value"].isNotNull()).alias("n_type_errors"),
                      F.max(R.rescued_keys()).alias("max_rescued_keys")))
    sums = [F.sum(c).alias(c) for c in ("n_rows", "n_rescued", "n_type_errors")]
    return (per_file.groupBy(F.col("day").cast("string").alias("day"))
                    .agg(*sums, F.max("max_rescued_keys").alias("max_rescued_keys")))


def _raw_json_events_with_id(spark, d, with_day: bool = False):
    e = V.table(spark, d, "events")
    val = F.when(F.col("event_id") % 50 == 0, F.lit('"abc"')).otherwise(F.col("value").cast("string"))
    ts = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(',"ts":"'), F.col("ts").cast("string"), F.lit('"'))).otherwise(F.lit(""))
    text = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"user_id":'), F.col("user_id").cast("string"),
                    F.lit(',"event_type":"'), F.col("event_type"), F.lit('","value":'), val,
                    F.lit(',"extra":'), F.col("props"), ts, F.lit("}"))
    extra = [F.date_format("ts", "yyyy-MM-dd").alias("day")] if with_day else []
    return e.select("event_id", text.alias("text"), *extra)
