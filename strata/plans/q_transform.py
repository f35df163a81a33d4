"""Projection, filter, set, sort and scalar-function queries (built-in operators)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from strata.functions import hashing as H
from strata.functions import parsing as P
from strata.functions.money import money_sum
from strata.plans import views as V
from strata.plans.registry import query

# ------------------------------------------------------------------ business parsers (EXP-*)

# Amount text derived from lineitem prices in four shapes: plain ('1234.56'),
# Brazilian with thousands ('1.234,56'), Brazilian without ('1234,56'), and junk.
_AMOUNT_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cents, CASE
    WHEN (l_partkey + l_linenumber) % 5 = 0 THEN 'abc' || CAST(l_partkey AS VARCHAR)
    WHEN (l_partkey + l_linenumber) % 7 = 0 THEN '  '
    WHEN l_linenumber % 3 = 0 THEN CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
    WHEN l_linenumber % 3 = 1 THEN (CASE WHEN cents // 100 >= 1000
         THEN CAST(cents // 100000 AS VARCHAR) || '.' || lpad(CAST((cents // 100) % 1000 AS VARCHAR), 3, '0')
         ELSE CAST(cents // 100 AS VARCHAR) END) || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
    ELSE ' ' || CAST(cents // 100 AS VARCHAR) || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END AS s
  FROM (SELECT *, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)"""


def _amount_text(spark, d):
    li = V.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    li = li.withColumn("cents", cents)
    ip, fr = F.floor(F.col("cents") / 100).cast("bigint"), F.lpad((F.col("cents") % 100).cast("string"), 2, "0")
    thousands = F.when(ip >= 1000, F.concat(F.floor(ip / 1000).cast("bigint").cast("string"), F.lit("."),
                                            F.lpad((ip % 1000).cast("string"), 3, "0"))).otherwise(ip.cast("string"))
    k = F.col("l_partkey") + F.col("l_linenumber")
    s = (F.when(k % 5 == 0, F.concat(F.lit("abc"), F.col("l_partkey").cast("string")))
          .when(k % 7 == 0, F.lit("  "))
          .when(F.col("l_linenumber") % 3 == 0, F.concat(ip.cast("string"), F.lit("."), fr))
          .when(F.col("l_linenumber") % 3 == 1, F.concat(thousands, F.lit(","), fr))
          .otherwise(F.concat(F.lit(" "), ip.cast("string"), F.lit(","), fr)))
    return li.withColumn("s", s)


@query("exp_parse_brl", f"""
SELECT l_orderkey, l_linenumber, s,
  CASE WHEN s LIKE 'abc%' OR trim(s) = '' THEN NULL ELSE CAST(cents AS DOUBLE) / 100 END AS valor
FROM ({_AMOUNT_SQL})""")
def exp_parse_brl(spark, d):
    """EXP-1: '4.90', '1.234,56', '12,5' -> double; blank and junk -> NULL."""
    t = _amount_text(spark, d)
    return t.select("l_orderkey", "l_linenumber", "s", P.parse_brl("s").alias("valor"))


@query("exp_parse_date", """
SELECT o_orderkey, s, CASE WHEN o_orderkey % 5 IN (0, 1) THEN CAST(o_orderdate AS DATE) END AS data_ref FROM (
  SELECT o_orderkey, o_orderdate, CASE o_orderkey % 5
    WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y')
    WHEN 1 THEN ' ' || strftime(o_orderdate, '%-d/%-m/%Y')
    WHEN 2 THEN '31/02/' || strftime(o_orderdate, '%Y')
    WHEN 3 THEN strftime(o_orderdate, '%d/%m/%y')
    ELSE 'xx/' || strftime(o_orderdate, '%m/%Y') END AS s FROM orders)""")
def exp_parse_date(spark, d):
    """EXP-2: dd/MM/yyyy (1- or 2-digit day/month) -> DATE; 31/02, 2-digit years, junk -> NULL."""
    o = V.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey") % 5
    s = (F.when(k == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
          .when(k == 1, F.concat(F.lit(" "), F.date_format("o_orderdate", "d/M/yyyy")))
          .when(k == 2, F.concat(F.lit("31/02/"), F.date_format("o_orderdate", "yyyy")))
          .when(k == 3, F.date_format("o_orderdate", "dd/MM/yy"))
          .otherwise(F.concat(F.lit("xx/"), F.date_format("o_orderdate", "MM/yyyy"))))
    return o.select("o_orderkey", s.alias("s")).select("o_orderkey", "s", P.parse_date_br("s").alias("data_ref"))


@query("exp_catalogued", V.with_views("""
SELECT event_id, s, CASE WHEN event_id % 4 = 3 THEN FALSE ELSE codigo_serie IN (1, 11, 433) END AS catalogada FROM (
  SELECT event_id, codigo_serie, CASE event_id % 4 WHEN 0 THEN CAST(codigo_serie AS VARCHAR)
    WHEN 1 THEN ' ' || CAST(codigo_serie AS VARCHAR) || ' ' WHEN 2 THEN '+' || CAST(codigo_serie AS VARCHAR)
    ELSE 'x' || CAST(codigo_serie AS VARCHAR) END AS s FROM obs)""", "obs"))
def exp_catalogued(spark, d):
    """EXP-3: integer-castable and catalogued -> TRUE, else FALSE (never NULL)."""
    o = V.obs(spark, d)
    c = F.col("codigo_serie").cast("string")
    k = F.col("event_id") % 4
    s = (F.when(k == 0, c).when(k == 1, F.concat(F.lit(" "), c, F.lit(" ")))
          .when(k == 2, F.concat(F.lit("+"), c)).otherwise(F.concat(F.lit("x"), c)))
    return o.select("event_id", s.alias("s")).select("event_id", "s", P.is_catalogued("s").alias("catalogada"))


@query("exp_latest_obs", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_linenumber % 3 = 2 THEN CAST(l_suppkey AS VARCHAR) ELSE CAST(l_partkey AS VARCHAR) END AS valor
FROM lineitem""")
def exp_latest_obs(spark, d):
    """EXP-4: element with the latest valid date in an array<struct<data, valor>>; ties -> first."""
    li = V.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    shift = (F.col("l_linenumber") % 3 - 1).cast("int")
    arr = F.array(
        F.struct(F.date_format("l_shipdate", "dd/MM/yyyy").alias("data"), F.col("l_partkey").cast("string").alias("valor")),
        F.struct(F.date_format(F.date_add(F.col("l_shipdate").cast("date"), shift), "dd/MM/yyyy").alias("data"),
                 F.col("l_suppkey").cast("string").alias("valor")),
        F.struct(F.lit("xx").alias("data"), F.lit("9").alias("valor")),
    )
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     P.latest_observation(arr)["valor"].alias("valor"))


# ------------------------------------------------------------------ projections

@query("prj_select", V.with_views("""
SELECT *, 'sgs' AS fonte, valor * 2 AS valor_dobro FROM obs""", "obs"))
def prj_select(spark, d):
    """PRJ-1: star plus extra columns with aliases."""
    return V.obs(spark, d).select("*", F.lit("sgs").alias("fonte"), (F.col("valor") * 2).alias("valor_dobro"))


@query("prj_except", V.with_views("SELECT * EXCLUDE (seq, user_id) FROM obs", "obs"))
def prj_except(spark, d):
    """PRJ-2: all columns except some (COLUMNS * EXCEPT)."""
    return V.obs(spark, d).drop("seq", "user_id")


@query("prj_rename", """
SELECT p_partkey AS part_id, p_brand AS brand, string_split(p_name, ' ') AS words, upper(p_type) AS kind
FROM part WHERE len(string_split(p_name, ' ')) >= 2""")
def prj_rename(spark, d):
    """PRJ-3: columns renamed, derived, filtered on a derived value and dropped."""
    p = V.table(spark, d, "part").select("p_partkey", "p_brand", "p_name", "p_type")
    made = p.withColumns({"words": F.split("p_name", " "), "kind": F.upper("p_type")}).where(F.size("words") >= 2)
    return made.withColumnsRenamed({"p_partkey": "part_id", "p_brand": "brand"}).drop("p_name", "p_type")


@query("prj_explode", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS palavra FROM part""")
def prj_explode(spark, d):
    """PRJ-4: explode an array column (generator; empty arrays yield no row)."""
    p = V.table(spark, d, "part")
    return p.select("p_partkey", F.explode(F.split("p_name", " ")).alias("palavra"))


def _payload(spark, d):
    o = V.table(spark, d, "orders")
    item = F.struct(F.lit("IPCA").alias("Indicador"), F.col("o_totalprice").alias("Mediana"),
                    F.col("o_orderkey").alias("numeroRespondentes"))
    return o.select("o_orderkey", F.struct(F.concat(F.lit("ctx/"), F.col("o_orderpriority")).alias("@odata.context"),
                                           F.array(item).alias("value")).alias("payload"))


@query("prj_nested", """
SELECT o_orderkey, 'ctx/' || o_orderpriority AS contexto, 'IPCA' AS primeiro_indicador,
       o_totalprice AS mediana_via_json, o_totalprice AS mediana_via_variant FROM orders""")
def prj_nested(spark, d):
    """PRJ-5: struct dot/backtick access, array index, JSON path and VARIANT path."""
    p = _payload(spark, d)
    first = F.col("payload.value")[0]
    return p.select("o_orderkey", F.col("payload.`@odata.context`").alias("contexto"),
                    first["Indicador"].alias("primeiro_indicador"),
                    F.get_json_object(F.to_json(first), "$.Mediana").cast("double").alias("mediana_via_json"),
                    F.variant_get(F.parse_json(F.to_json(first)), "$.Mediana", "double").alias("mediana_via_variant"))


@query("prj_cast", """
SELECT o_orderkey, CAST(o_orderkey AS INTEGER) AS chave_int, TRY_CAST(o_orderpriority AS INTEGER) AS prioridade_bruta,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prioridade, CAST(o_orderdate AS DATE) AS data_pedido,
       CAST(FLOOR(o_totalprice) AS BIGINT) AS preco_inteiro FROM orders""")
def prj_cast(spark, d):
    """PRJ-6: typed cast and tolerant cast (try_cast)."""
    o = V.table(spark, d, "orders")
    return o.select("o_orderkey", F.col("o_orderkey").cast("int").alias("chave_int"),
                    F.col("o_orderpriority").try_cast("int").alias("prioridade_bruta"),
                    F.substring("o_orderpriority", 1, 1).try_cast("int").alias("prioridade"),
                    F.col("o_orderdate").cast("date").alias("data_pedido"),
                    F.floor(F.col("o_totalprice")).cast("bigint").alias("preco_inteiro"))


@query("prj_case", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'negativo' WHEN c_acctbal < 5000 THEN 'baixo' ELSE 'alto' END AS faixa,
       COALESCE(CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END, 'SEM_SEGMENTO') AS segmento FROM customer""")
def prj_case(spark, d):
    """PRJ-7: CASE WHEN and COALESCE."""
    c = V.table(spark, d, "customer")
    seg = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None)).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", F.when(F.col("c_acctbal") < 0, "negativo").when(F.col("c_acctbal") < 5000, "baixo")
                    .otherwise("alto").alias("faixa"), F.coalesce(seg, F.lit("SEM_SEGMENTO")).alias("segmento"))


@query("prj_standardize", """
SELECT s_suppkey, s_name || ' / ' || CAST(s_nationkey AS VARCHAR) AS full_name FROM supplier""")
def prj_standardize(spark, d):
    """PRJ-8: derived column (concatenation) in a projection."""
    s = V.table(spark, d, "supplier")
    return s.select("s_suppkey", F.concat("s_name", F.lit(" / "), F.col("s_nationkey").cast("string")).alias("full_name"))


# ------------------------------------------------------------------ filters

@query("flt_basic", V.with_views("""
SELECT codigo_serie, data_ref, valor FROM obs
WHERE codigo_serie IS NOT NULL AND (valor >= 100 OR codigo_serie IN (1, 11)) AND NOT (valor IS NULL)""", "obs"))
def flt_basic(spark, d):
    """FLT-1: comparison, IN, AND/OR, IS [NOT] NULL (pushed to the parquet scan)."""
    o = V.obs(spark, d)
    return o.filter(F.col("codigo_serie").isNotNull() & ((F.col("valor") >= 100) | F.col("codigo_serie").isin(1, 11))
                    & F.col("valor").isNotNull()).select("codigo_serie", "data_ref", "valor")


@query("flt_like", """
SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%bolt%' AND p_brand NOT LIKE 'Brand#1%' AND regexp_matches(p_type, '^(SMALL|LARGE)')""")
def flt_like(spark, d):
    """FLT-2: LIKE, NOT LIKE, RLIKE."""
    p = V.table(spark, d, "part")
    return p.filter(F.col("p_name").like("%bolt%") & ~F.col("p_brand").like("Brand#1%") &
                    F.col("p_type").rlike("^(SMALL|LARGE)")).select("p_partkey", "p_name")


@query("flt_recent", """
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_shipdate >= DATE '2001-06-30' - INTERVAL 90 DAY""")
def flt_recent(spark, d):
    """FLT-3: rolling date window relative to an as-of literal (pushed down)."""
    li = V.table(spark, d, "lineitem")
    cutoff = F.date_sub(F.lit(date(2001, 6, 30)), 90)
    return li.filter(F.col("l_shipdate") >= cutoff).select("l_orderkey", "l_linenumber", "l_shipdate")


@query("flt_alerts", """
SELECT date_trunc('hour', ts) AS hora, user_id, COUNT(*) AS eventos, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events GROUP BY 1, 2 HAVING SUM(CAST(value AS DECIMAL(18,2))) > 300""")
def flt_alerts(spark, d):
    """FLT-5: hourly metrics over a bound are sent downstream as alerts."""
    e = V.table(spark, d, "events")
    h = (e.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hora"), "user_id")
          .agg(F.count(F.lit(1)).alias("eventos"), money_sum("value").alias("total")))
    return h.filter(F.col("total") > 300)


# ------------------------------------------------------------------ set operations / sort

@query("set_distinct", V.with_views("SELECT DISTINCT codigo_serie, data_ref FROM obs", "obs"))
def set_distinct(spark, d):
    """SET-1: distinct keys."""
    return V.obs(spark, d).select("codigo_serie", "data_ref").distinct()


@query("set_drop_duplicates", V.with_views("SELECT DISTINCT codigo_serie, data_ref FROM obs", "obs"))
def set_drop_duplicates(spark, d):
    """SET-2: dropDuplicates on keys (arbitrary survivor; only the keys are compared)."""
    return V.obs(spark, d).dropDuplicates(["codigo_serie", "data_ref"]).select("codigo_serie", "data_ref")


@query("set_union", """
SELECT o_orderkey AS chave, o_totalprice AS valor FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_returnflag = 'R'""")
def set_union(spark, d):
    """SET-3: union by position."""
    o = V.table(spark, d, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("chave"),
                                                                                F.col("o_totalprice").alias("valor"))
    li = V.table(spark, d, "lineitem").filter(F.col("l_returnflag") == "R").select("l_orderkey", "l_extendedprice")
    return o.union(li)


@query("set_union_by_name", """
SELECT c_custkey AS party_key, c_name AS party_name, c_mktsegment AS segment, NULL::DOUBLE AS quantity FROM customer
UNION ALL SELECT l_suppkey, NULL, NULL, l_quantity FROM lineitem WHERE l_returnflag = 'R'""")
def set_union_by_name(spark, d):
    """SET-4: unionByName of parties with different columns (those a side lacks are NULL)."""
    returns = V.table(spark, d, "lineitem").where("l_returnflag = 'R'").selectExpr("l_quantity AS quantity", "l_suppkey AS party_key")
    customers = V.table(spark, d, "customer").selectExpr("c_custkey AS party_key", "c_name AS party_name", "c_mktsegment AS segment")
    return customers.unionByName(returns, allowMissingColumns=True)


@query("srt_topk", """
SELECT o_orderkey, o_totalprice, o_orderdate FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 10""")
def srt_topk(spark, d):
    """SRT-1: order by several keys + limit (TakeOrderedAndProject: per-task top-k, no full sort)."""
    o = V.table(spark, d, "orders")
    return o.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc()).limit(10) \
        .select("o_orderkey", "o_totalprice", "o_orderdate")


# ------------------------------------------------------------------ scalar families

@query("fn_string", """
SELECT c_custkey, string_split(c_name, '#')[2] AS numero, lower(c_mktsegment) AS seg_lower, trim('  ' || c_mktsegment || ' ') AS seg_trim,
       concat(c_name, '-', c_mktsegment) AS nome_seg, concat_ws('|', c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS cw,
       right(c_name, 3) AS ult3, substring(c_name, -4, 4) AS ult4, repeat('*', CAST(c_nationkey % 5 AS INTEGER)) AS estrelas,
       CAST(length(c_name) AS INTEGER) AS tam, regexp_extract(c_name, '([0-9]+)$', 1) AS digitos,
       regexp_replace(c_name, '[0-9]', 'x', 'g') AS sem_digitos FROM customer""")
def fn_string(spark, d):
    """String functions: split+index, lower, trim, concat(_ws), right, substr(-n), repeat, length, regexp_*."""
    c = V.table(spark, d, "customer")
    return c.select("c_custkey", F.get(F.split("c_name", "#"), 1).alias("numero"), F.lower("c_mktsegment").alias("seg_lower"),
                    F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("seg_trim"),
                    F.concat("c_name", F.lit("-"), "c_mktsegment").alias("nome_seg"),
                    F.concat_ws("|", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("cw"),
                    F.right("c_name", F.lit(3)).alias("ult3"), F.substring("c_name", -4, 4).alias("ult4"),
                    F.repeat(F.lit("*"), (F.col("c_nationkey") % 5).cast("int")).alias("estrelas"),
                    F.length("c_name").alias("tam"), F.regexp_extract("c_name", "([0-9]+)$", 1).alias("digitos"),
                    F.regexp_replace("c_name", "[0-9]", "x").alias("sem_digitos"))


@query("fn_hash", """
SELECT c_custkey, md5(c_name) AS md5_nome, sha256(c_name) AS sha_nome,
       md5(concat_ws('|', COALESCE(c_name, chr(0)), COALESCE(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END, chr(0)),
           COALESCE(CAST(c_nationkey AS VARCHAR), chr(0)))) AS row_hash FROM customer""")
def fn_hash(spark, d):
    """md5 / sha2-256 and a NULL-aware row hash."""
    c = V.table(spark, d, "customer")
    seg = F.when(F.col("c_custkey") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", F.md5("c_name").alias("md5_nome"), F.sha2("c_name", 256).alias("sha_nome"),
                    H.content_hash(F.col("c_name"), seg, F.col("c_nationkey")).alias("row_hash"))


@query("fn_date", """
SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS via_texto,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS mes, CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY AS DATE) AS dia_seguinte,
       CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes_num, CAST(day(o_orderdate) AS INTEGER) AS dia,
       CAST(o_orderdate AS DATE) AS data, strptime(strftime(o_orderdate, '%Y-%m-%d') || ' 12:30:00', '%Y-%m-%d %H:%M:%S') AS ts_meio_dia
FROM orders""")
def fn_date(spark, d):
    """to_date(fmt), to_timestamp, date_trunc, date_add, year/month/day, DATE(ts)."""
    o = V.table(spark, d, "orders")
    return o.select("o_orderkey", F.to_date(F.date_format("o_orderdate", "dd/MM/yyyy"), "dd/MM/yyyy").alias("via_texto"),
                    F.date_trunc("month", "o_orderdate").cast("date").alias("mes"),
                    F.date_add(F.col("o_orderdate").cast("date"), 1).alias("dia_seguinte"),
                    F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes_num"),
                    F.dayofmonth("o_orderdate").alias("dia"), F.col("o_orderdate").cast("date").alias("data"),
                    F.to_timestamp_ntz(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 12:30:00"))).alias("ts_meio_dia"))


@query("fn_math", """
SELECT c_nationkey, CAST(ROUND(CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DECIMAL(38,4)) / 7, 4) AS DOUBLE) AS setimo,
       CAST(MAX(CAST(c_acctbal AS DECIMAL(18,2))) - MIN(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS amplitude,
       CAST(COUNT(*) FILTER (WHERE c_acctbal < 0) AS DOUBLE) / GREATEST(COUNT(*), 1) AS taxa_negativos
FROM customer GROUP BY c_nationkey""")
def fn_math(spark, d):
    """round(x, 4), subtraction, ratio guarded by greatest(total, 1)."""
    c = V.table(spark, d, "customer")
    bal = F.col("c_acctbal").cast("decimal(18,2)")
    return (c.groupBy("c_nationkey")
             .agg(F.round(F.sum(bal).cast("decimal(38,4)") / 7, 4).cast("double").alias("setimo"),
                  (F.max(bal) - F.min(bal)).cast("double").alias("amplitude"),
                  (F.count_if(F.col("c_acctbal") < 0).cast("double") / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("taxa_negativos")))


@query("fn_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_path, CAST(props->>'k' AS INTEGER) AS k_struct,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k_variant,
       '{"k":' || CAST(props->>'k' AS VARCHAR) || ',"user":' || CAST(user_id AS VARCHAR) || '}' AS como_json FROM events""")
def fn_json(spark, d):
    """from_json, get_json_object, parse_json + variant_get, to_json on events.props."""
    e = V.table(spark, d, "events")
    st = F.from_json("props", "k INT")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k_path"),
                    st["k"].alias("k_struct"), F.variant_get(F.parse_json("props"), "$.k", "int").alias("k_variant"),
                    F.to_json(F.struct(st["k"].alias("k"), F.col("user_id").alias("user"))).alias("como_json"))
