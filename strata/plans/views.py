"""Views over the driver tables, written once for Spark and once for DuckDB.

Each view maps a driver table onto an entity of the medallion lab (series
observations, customer change feed, market expectations, ...). The Spark
version reads only the columns it needs, so the parquet scan is pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_views(sql: str, *names: str) -> str:
    """Prefix an oracle query with the CTEs of the named views (dependencies first)."""
    order: list[str] = []

    def add(n):
        for dep in VIEW_DEPS.get(n, ()):
            add(dep)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in order)
    return f"WITH {ctes}\n{sql}"


# ------------------------------------------------------------------ obs
# Series observations from events: view -> 1, click -> 11, purchase -> 433,
# anything else -> 9999 (a code outside the catalogue).

def obs(spark, d) -> DataFrame:
    return observations(table(spark, d, "events"))


def observations(e: DataFrame) -> DataFrame:
    code = (F.when(F.col("event_type") == "view", 1).when(F.col("event_type") == "click", 11)
             .when(F.col("event_type") == "purchase", 433).otherwise(9999).cast("int"))
    return e.select(code.alias("codigo_serie"), F.col("event_type").alias("nome_serie"),
                    F.col("ts").cast("date").alias("data_ref"), F.col("value").alias("valor"),
                    F.col("ts").alias("seq"), "event_id", "user_id")


OBS_SQL = """SELECT CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 11 WHEN 'purchase' THEN 433
             ELSE 9999 END AS INTEGER) AS codigo_serie, event_type AS nome_serie, CAST(ts AS DATE) AS data_ref,
             value AS valor, ts AS seq, event_id, user_id FROM events"""

# ------------------------------------------------------------------ clientes_cdc
# Customer change feed from events: signup -> INSERT, error -> DELETE, else UPDATE.

# State codes of the feed; the seventh is outside the accepted list.
UF_CODES = ("SP", "RJ", "MG", "RS", "PR", "BA", "XX")
UF_ACCEPTED = ("SP", "RJ", "MG", "RS", "PR", "BA")


def clientes_cdc(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    uf = F.element_at(F.array(*[F.lit(u) for u in UF_CODES]), (F.col("event_id") % 7 + 1).cast("int"))
    op = (F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE")
           .otherwise("UPDATE"))
    uid = F.col("user_id").cast("string")
    email = (F.when(F.col("event_id") % 20 == 0, F.concat(F.lit("user"), uid, F.lit(".example.com")))
              .otherwise(F.concat(F.lit("user"), uid, F.lit("@example.com"))))
    cpf = F.concat(F.lit("123.456."), uid, F.lit("-"), (F.col("event_id") % 100).cast("string"))
    seg = F.when(F.col("value") >= 250, "alta_renda").otherwise("varejo")
    return e.select(F.col("user_id").alias("cliente_id"), F.concat(F.lit("Cliente "), uid).alias("nome"),
                    uf.alias("uf"), seg.alias("segmento"), email.alias("email"), cpf.alias("cpf"),
                    op.alias("operacao"), F.col("ts").alias("ts_evento"), "event_id")


CLIENTES_SQL = """SELECT user_id AS cliente_id, 'Cliente ' || CAST(user_id AS VARCHAR) AS nome,
  (['SP','RJ','MG','RS','PR','BA','XX'])[CAST(event_id % 7 AS INTEGER) + 1] AS uf,
  CASE WHEN value >= 250 THEN 'alta_renda' ELSE 'varejo' END AS segmento,
  CASE WHEN event_id % 20 = 0 THEN 'user' || CAST(user_id AS VARCHAR) || '.example.com'
       ELSE 'user' || CAST(user_id AS VARCHAR) || '@example.com' END AS email,
  '123.456.' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id % 100 AS VARCHAR) AS cpf,
  CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operacao,
  ts AS ts_evento, event_id FROM events"""

# ------------------------------------------------------------------ expectativas / realizado


def expectativas(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(F.lit("IPCA").alias("indicador"), F.col("o_orderdate").cast("date").alias("data_boletim"),
                    F.date_trunc("month", "o_orderdate").cast("date").alias("mes_referencia"),
                    F.col("o_totalprice").alias("mediana"), "o_orderkey")


EXPECTATIVAS_SQL = """SELECT 'IPCA' AS indicador, CAST(o_orderdate AS DATE) AS data_boletim,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS mes_referencia, o_totalprice AS mediana, o_orderkey FROM orders"""


def realizado(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_shipdate").alias("data_ref"), F.col("l_extendedprice").alias("valor"))


REALIZADO_SQL = "SELECT l_shipdate AS data_ref, l_extendedprice AS valor FROM lineitem"

# ------------------------------------------------------------------ star schema


def net_revenue(price: str, discount: str):
    """price * (1 - discount) rounded half-up to cents, exact (integer cents)."""
    from strata.functions.money import net_amount
    return net_amount(price, discount)


def fact_lines(spark, d) -> DataFrame:
    """Line-grain fact: lineitem joined to its order (both big: shuffle join)."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                             "l_extendedprice", "l_discount", "l_shipdate", "l_returnflag")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_number"),
                    F.col("o_custkey").alias("customer_key"), F.col("l_partkey").alias("part_key"),
                    F.col("l_suppkey").alias("supplier_key"), F.col("o_orderdate").cast("date").alias("order_date"),
                    F.col("l_shipdate").cast("date").alias("ship_date"), F.col("l_quantity").alias("quantity"),
                    net_revenue("l_extendedprice", "l_discount").alias("revenue"),
                    F.col("o_orderstatus").alias("order_status"), F.col("l_returnflag").alias("return_flag"))


FACT_SQL = """SELECT l_orderkey AS order_key, l_linenumber AS line_number, o_custkey AS customer_key,
  l_partkey AS part_key, l_suppkey AS supplier_key, CAST(o_orderdate AS DATE) AS order_date,
  CAST(l_shipdate AS DATE) AS ship_date, l_quantity AS quantity,
  CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))), 2) AS DOUBLE) AS revenue, o_orderstatus AS order_status,
  l_returnflag AS return_flag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def dim_geo(spark, d) -> DataFrame:
    """nation x region (the planner broadcasts what is below its size threshold)."""
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


# ------------------------------------------------------------------ snapshots for snapshot-SCD2 / upsert


def snapshot_1(spark, d) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def snapshot_2(spark, d) -> DataFrame:
    """Customer snapshot a day later: balances change for key % 5 = 0, keys % 11 = 0
    leave, the segment turns NULL for key % 13 = 0, new (negative) keys appear."""
    c = snapshot_1(spark, d)
    k = F.col("c_custkey")
    changed = c.filter(k % 11 != 0).select(
        "c_custkey", "c_name", "c_nationkey",
        F.when(k % 5 == 0, F.round(F.col("c_acctbal") + 100, 2)).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when((k % 13 == 0) & F.col("c_mktsegment").isNotNull(), F.lit(None).cast("string"))
         .otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    new = c.filter(k % 7 == 3).select((-k - 1).alias("c_custkey"), "c_name", "c_nationkey",
                                      "c_acctbal", "c_mktsegment")
    return changed.unionByName(new)


SNAP1_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
SNAP2_SQL = """SELECT c_custkey, c_name, c_nationkey,
    CASE WHEN c_custkey % 5 = 0 THEN ROUND(c_acctbal + 100, 2) ELSE c_acctbal END AS c_acctbal,
    CASE WHEN c_custkey % 13 = 0 AND c_mktsegment IS NOT NULL THEN NULL ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_custkey % 11 <> 0
  UNION ALL
  SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 7 = 3"""


VIEW_SQL = {
    "obs": OBS_SQL,
    "clientes_cdc": CLIENTES_SQL,
    "expectativas": EXPECTATIVAS_SQL,
    "realizado": REALIZADO_SQL,
    "fact_lines": FACT_SQL,
    "snapshot_1": SNAP1_SQL,
    "snapshot_2": SNAP2_SQL,
}
VIEW_DEPS: dict[str, tuple[str, ...]] = {}


def register_view_sql(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    VIEW_SQL[name] = sql
    VIEW_DEPS[name] = deps
