"""Gold modelling: star schema, conformed dimensions, calendar, standardization."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.money import money_mean, money_sum
from strata.operators.dedup import dedup_latest
from strata.operators.layout import files_for

# The series catalogue seed (code, unit, periodicity). 9998 is a
# catalogued code that never has observations.
SERIES_CATALOGUE = [
    (1, "BRL", "diaria"),
    (11, "% a.d.", "diaria"),
    (433, "% a.m.", "mensal"),
    (9998, "x", "nenhuma"),
]

#: Input bytes (of all joined tables) whose lines one task of ``daily_revenue`` groups.
TASK_MB = 8


def dim_series(spark: SparkSession) -> DataFrame:
    """The series catalogue, as literals, so that the planner knows its size."""
    names = ("codigo_serie", "unidade", "periodicidade")
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in SERIES_CATALOGUE]
    return spark.range(1).select(F.inline(F.array(*rows)))


def daily_revenue(star_df: DataFrame) -> DataFrame:
    """Lines, revenue (exact), mean line revenue (exact, half-up) and distinct orders.

    Nearly every line is an (order, group) of its own, which tasks hold until orders are counted. So many lines are first
    dealt by group and order to tasks of bounded input, apart from the joins that made them.
    """
    spark, group = star_df.sparkSession, ["order_date", "region", "category"]
    lines, tasks = star_df.select(*group, "order_key", "revenue"), files_for(spark, star_df.inputFiles(), TASK_MB)
    if tasks > spark.sparkContext.defaultParallelism:
        lines = lines.repartition(tasks, *group, "order_key")
    return (lines.groupBy(*group)
                   .agg(F.count(F.lit(1)).alias("line_count"), money_sum("revenue").alias("revenue"),
                        money_mean("revenue").alias("avg_line_revenue"),
                        F.count_distinct("order_key").alias("orders")))


def customer_lifetime_value(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("customer_key")
                .agg(F.count_distinct("order_key").alias("orders"),
                     money_sum("revenue").alias("lifetime_revenue"),
                     F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order")))


def dim_date(spark: SparkSession, start, end) -> DataFrame:
    """Calendar rows from ``start`` to ``end`` (inclusive), generated across tasks."""
    n = (end - start).days + 1
    base = spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"))
    return base.select(F.date_format("date", "yyyyMMdd").cast("int").alias("date_id"), "date",
                       F.year("date").alias("year"), F.month("date").alias("month"),
                       F.dayofmonth("date").alias("day"), F.quarter("date").alias("quarter"),
                       ((F.dayofweek("date") + 5) % 7 + 1).alias("day_of_week"))


def dim_date_between(df: DataFrame, col: str) -> DataFrame:
    """Calendar covering the dates of ``df[col]`` (two scalars reach the driver)."""
    row = df.agg(F.min(col).cast("date").alias("a"), F.max(col).cast("date").alias("b")).collect()[0]
    return dim_date(df.sparkSession, row["a"], row["b"])


def standardize_customers(raw: DataFrame) -> DataFrame:
    """Split name (NULL last name for one word), clean e-mail, phone digits and country, defaults."""
    parts = F.split(F.col("customer_name"), " ")
    phone = F.col("phone_number")
    country = F.when(phone.startswith("+"), F.regexp_extract(phone, r"^\+([0-9]+)", 1)).otherwise(F.lit("55"))
    return raw.select(
        "customer_id",
        F.get(parts, 0).alias("first_name"),
        F.get(parts, 1).alias("last_name"),
        F.col("customer_name").alias("full_name"),
        F.lower(F.trim(F.col("email_address"))).alias("email"),
        F.regexp_extract(phone, r"[0-9]{10,}$", 0).alias("phone_digits"),
        country.alias("phone_country"),
        "is_active",
        F.coalesce(F.col("c_mktsegment"), F.lit("UNKNOWN")).alias("segment"),
    )


def unify_sources(sources: dict[str, tuple[DataFrame, int]], keys: list[str], columns: list[str]) -> DataFrame:
    """Union several sources by name; per key the source with the highest priority wins, within a source (and among
    sources of one priority) the row with the smallest values in the order of ``columns`` (nulls last), so that repeats give the same."""
    frames = [df.select(*columns).withColumn("source", F.lit(name)).withColumn("__prio", F.lit(prio))
              for name, (df, prio) in sources.items()]
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    return dedup_latest(u, keys, "__prio", [c for c in columns if c not in keys] + ["source"]).drop("__prio")
