"""The three-feed pipeline (``lab``) over feeds landed from the driver tables, in several drops."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.plans import lab as L
from strata.plans import views as V
from strata.plans.q_cdc import SCD2_SQL
from strata.plans.q_stream import _mean4_sql
from strata.plans.registry import query
from strata.session import work_path
from strata.sources.landing import TS_FORMAT
from strata.streaming import cdc_stream as CS

AS_OF = datetime(2024, 2, 1)
#: Order keys in one envelope: it holds a bounded number of rows at any size of the tables.
ENVELOPE = 200

SERIES_SQL = f"""env AS (SELECT l_returnflag AS flag, date_trunc('month', l_shipdate) AS m, l_orderkey // {ENVELOPE} AS e, max(l_shipdate) AS coletado FROM lineitem GROUP BY ALL),
obs AS (SELECT CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 11 ELSE 433 END AS codigo_serie, 'Serie ' || l_returnflag AS nome_serie,
  CAST(l_shipdate AS DATE) AS data_ref, l_extendedprice AS valor, coletado FROM lineitem
  JOIN env ON flag = l_returnflag AND m = date_trunc('month', l_shipdate) AND e = l_orderkey // {ENVELOPE} WHERE l_orderkey % 101 <> 0),
silver AS (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY codigo_serie, data_ref ORDER BY coletado DESC, valor) = 1)"""
INDICATORS_SQL = f"""WITH {SERIES_SQL}
SELECT codigo_serie, nome_serie, CAST(date_trunc('month', data_ref) AS DATE) AS mes, {_mean4_sql('valor')} AS valor_medio, MIN(valor) AS valor_minimo,
  MAX(valor) AS valor_maximo, arg_max(valor, data_ref) AS valor_fechamento, COUNT(*) AS qtd_observacoes FROM silver GROUP BY ALL"""


def series_envelopes(spark, d) -> DataFrame:
    """Series envelopes of line prices by return flag, month and run of orders; some values don't parse."""
    line = V.table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_shipdate", "l_extendedprice")
    number = F.translate(F.format_number("l_extendedprice", 2), ",.", ".,")
    one = F.struct(F.date_format("l_shipdate", "dd/MM/yyyy").alias("data"), F.when(F.col("l_orderkey") % 101 == 0, "n/d").otherwise(number).alias("valor"))
    code = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 11).otherwise(433)
    return (line.groupBy(code.alias("codigo_serie"), F.concat(F.lit("Serie "), "l_returnflag").alias("nome_serie"),
                         F.year("l_shipdate").alias("ano"), F.month("l_shipdate").alias("m"), F.floor(F.col("l_orderkey") / ENVELOPE).alias("e"))
                .agg(F.max("l_shipdate").alias("coletado_em"), F.lit("linhas").alias("fonte"), F.collect_list(one).alias("observacoes")))


def expectation_envelopes(spark, d) -> DataFrame:
    """Market reports of order prices by month and run of orders; some have no median."""
    o = V.table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    price = F.when(F.col("o_orderkey") % 97 != 0, F.col("o_totalprice"))
    one = F.struct(F.lit("IPCA").alias("Indicador"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("Data"), F.date_format("o_orderdate", "MM/yyyy").alias("DataReferencia"),
                   F.col("o_totalprice").alias("Media"), price.alias("Mediana"), F.lit(10).alias("numeroRespondentes"))
    return (o.groupBy(F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("m"), F.floor(F.col("o_orderkey") / ENVELOPE).alias("e"))
             .agg(F.max("o_orderdate").alias("coletado_em"), F.lit("pedidos").alias("endpoint"), F.struct(F.collect_list(one).alias("value")).alias("payload")))


def _drop(df: DataFrame, n: int) -> DataFrame:
    """Part ``n`` of a feed: most envelopes of the years before 1998 land first, all others after."""
    first = (F.col("ano") < 1997) | ((F.col("ano") == 1997) & (F.col("e") % 2 == 0))
    return df.filter(first if n == 0 else ~first).drop("ano", "m", "e")


def _land(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("timestampNTZFormat", TS_FORMAT).json(path)


def _in_drops(spark, d, root: str, rebuild: bool = False) -> L.Lab:
    """The pipeline after each of two drops of the series and expectation feeds; with ``rebuild`` the second run starts anew."""
    feeds = {"sgs": series_envelopes(spark, d), "expectativas": expectation_envelopes(spark, d)}
    landing = {f: work_path(spark, f"landing-{f}") for f in feeds}
    for n in range(2):
        for f, df in feeds.items():
            _land(_drop(df, n), landing[f])
        lab, _ = L.run(spark, landing, root, AS_OF, full_refresh=rebuild and n == 1)
    return lab


@query("lab_indicadores", INDICATORS_SQL)
def lab_indicadores(spark, d):
    """STR-7, AGG-1, SNK-4: envelopes land in two drops; the second run refreshes only the months that its drop touched."""
    lab = _in_drops(spark, d, work_path(spark, "lab"))
    return spark.read.parquet(lab.gold["indicadores_mensais"])


@query("lab_surpresa", f"""WITH {SERIES_SQL},
r AS (SELECT CAST(date_trunc('month', data_ref) AS DATE) AS mes, arg_max(valor, data_ref) AS ipca_realizado FROM silver WHERE codigo_serie = 433 GROUP BY 1),
oenv AS (SELECT date_trunc('month', o_orderdate) AS m, o_orderkey // {ENVELOPE} AS e, max(o_orderdate) AS coletado FROM orders GROUP BY ALL),
rep AS (SELECT CAST(m AS DATE) AS mes, CAST(o_orderdate AS DATE) AS dia, o_totalprice AS mediana, coletado FROM orders
  JOIN oenv ON m = date_trunc('month', o_orderdate) AND e = o_orderkey // {ENVELOPE} WHERE o_orderkey % 97 <> 0),
x AS (SELECT * FROM rep QUALIFY row_number() OVER (PARTITION BY mes, dia ORDER BY coletado DESC, mediana) = 1),
e AS (SELECT mes, {_mean4_sql('mediana')} AS mediana_focus, COUNT(*) AS qtd_boletins FROM x GROUP BY mes)
SELECT coalesce(r.mes, e.mes) AS mes, mediana_focus, ipca_realizado, qtd_boletins, ROUND(ipca_realizado - mediana_focus, 4) AS surpresa
FROM r FULL OUTER JOIN e ON r.mes = e.mes""")
def lab_surpresa(spark, d):
    """STR-7, AGG-2: expected against realized value of one series, refreshed by the months that either feed touched."""
    lab = _in_drops(spark, d, work_path(spark, "lab"))
    return spark.read.parquet(lab.gold["expectativa_vs_realizado"])


@query("lab_full_refresh", INDICATORS_SQL)
def lab_full_refresh(spark, d):
    """STR-7: after the first drop the whole pipeline is rebuilt from all landing files."""
    lab = _in_drops(spark, d, work_path(spark, "lab"), rebuild=True)
    return spark.read.parquet(lab.gold["indicadores_mensais"])


@query("lab_clientes", V.with_views(f", {SCD2_SQL}\nSELECT * FROM scd2", "clientes_cdc"))
def lab_clientes(spark, d):
    """STR-7, CDC-2: the customer feed lands in three drops (late events among them) into SCD1 and SCD2 silver."""
    feed, landing, root = V.clientes_cdc(spark, d), work_path(spark, "landing-clientes"), work_path(spark, "lab")
    for n in range(3):
        _land(feed.filter(F.col("event_id") % 3 == n), landing)
        lab, _ = L.run(spark, {"clientes": landing}, root, AS_OF, limit=0.06)  # one address in twenty is bad
    return CS.scd2_history(spark, lab.history.path, ["cliente_id"], "ts_evento", "operacao = 'DELETE'", drop=["operacao", "event_id"])
