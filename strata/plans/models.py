"""Dataset-specific gold builders over the driver tables (star schema and friends)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.money import money_sum
from strata.plans import views as V


def star(spark: SparkSession, d: str) -> DataFrame:
    """Fact lines with customer, geography and part attributes.

    Each dimension is broadcast or shuffled by its size: the planner knows that of
    the files, AQE that of the shuffles.
    """
    f = V.fact_lines(spark, d)
    c = V.table(spark, d, "customer").select(F.col("c_custkey").alias("customer_key"), F.col("c_name").alias("customer_name"),
                                             F.col("c_mktsegment").alias("segment"), "c_nationkey")
    geo = V.dim_geo(spark, d).select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"),
                                     F.col("r_name").alias("region"))
    p = V.table(spark, d, "part").select(F.col("p_partkey").alias("part_key"), F.col("p_type").alias("category"),
                                         F.col("p_brand").alias("brand"))
    return (f.join(c, "customer_key").join(geo, "c_nationkey").join(p, "part_key").drop("c_nationkey"))


def tenant_daily(spark: SparkSession, d: str) -> DataFrame:
    o = V.table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = V.table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("tenant"))
    return (o.join(c, "o_custkey")
             .groupBy("tenant", F.col("o_orderdate").cast("date").alias("day"))
             .agg(F.count(F.lit(1)).alias("orders"),
                  money_sum("o_totalprice").alias("spend")))


def dim_customer(spark: SparkSession, d: str) -> DataFrame:
    c = V.table(spark, d, "customer")
    geo = V.dim_geo(spark, d)
    buyers = V.table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct() \
        .withColumn("has_orders", F.lit(True))
    out = (c.join(geo, c.c_nationkey == geo.n_nationkey, "left")
            .join(buyers, "c_custkey", "left"))
    return out.select(F.col("c_custkey").alias("customer_key"), F.col("c_name").alias("customer_name"),
                      F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"),
                      F.col("r_name").alias("region"), F.coalesce("has_orders", F.lit(False)).alias("has_orders"))


def raw_customers(spark: SparkSession, d: str) -> DataFrame:
    """Bronze-style customers derived from ``customer``: one-word names for key % 4 = 0,
    padded mixed-case e-mails, phones with and without a country code."""
    c = V.table(spark, d, "customer")
    k = F.col("c_custkey")
    name = F.when(k % 4 == 0, F.col("c_name")).otherwise(F.concat(F.lit("Ana "), F.col("c_name")))
    digits = (F.lit(9_000_000_000) + k).cast("string")
    phone = F.when(k % 3 == 0, F.concat(F.lit("11"), digits)).otherwise(F.concat(F.lit("+55 11"), digits))
    return c.select(k.cast("string").alias("customer_id"), name.alias("customer_name"),
                    F.concat(F.lit("  User"), k.cast("string"), F.lit("@Example.COM ")).alias("email_address"),
                    phone.alias("phone_number"), (F.col("c_acctbal") >= 0).alias("is_active"),
                    F.col("c_mktsegment"))
