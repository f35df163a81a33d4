"""Layout and retention queries: compaction, clustering, retention, bucketed joins."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from strata.functions.money import money_sum
from strata.operators import layout as L
from strata.operators.sinks import write_partitioned
from strata.plans import views as V
from strata.plans.registry import query
from strata.session import work_path

#: Input bytes (of both tables) for one bucket of ``lay_bucketed``.
BUCKET_MB = 16
LI_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"]


@query("lay_compact", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate FROM lineitem")
def lay_compact(spark, d):
    """LAY-1: many small files rewritten into files of the target size; same rows."""
    small = work_path(spark, "small-files")
    V.table(spark, d, "lineitem").select(*LI_COLS).repartition(64).write.mode("overwrite").parquet(small)
    out = L.compact(spark, small, work_path(spark, "compacted"), target_mb=1)
    return spark.read.parquet(out)


@query("lay_cluster", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-03-01' AND o_orderdate < TIMESTAMP '1998-04-01'""")
def lay_cluster(spark, d):
    """LAY-2: range-clustered, sorted files; a date filter then reads few row groups."""
    o = V.table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    path = work_path(spark, "clustered-orders")
    L.cluster(o, ["o_orderdate"], 8).write.mode("overwrite").parquet(path)
    lo, hi = F.lit("1998-03-01").cast("timestamp_ntz"), F.lit("1998-04-01").cast("timestamp_ntz")
    return spark.read.parquet(path).filter((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi))


@query("lay_interleaved", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_totalprice >= 200000 AND o_totalprice < 210000""")
def lay_interleaved(spark, d):
    """LAY-2: clustered by date and price on a space-filling curve; a filter on the second column skips files, too."""
    o = V.table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    path = work_path(spark, "interleaved-orders")
    files = max(16, L.files_for(spark, [f"{d}/orders.parquet"]))
    L.cluster_interleaved(o, ["o_orderdate", "o_totalprice"], files).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).filter((F.col("o_totalprice") >= 200000) & (F.col("o_totalprice") < 210000))


RETENTION_AS_OF = date(2024, 4, 15)  # bronze keeps 90 days -> from 2024-01-16


@query("lay_retention", """
SELECT event_id, ts, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-16'""")
def lay_retention(spark, d):
    """LAY-3: bronze retention (90 days): whole old day partitions dropped, no file rewritten."""
    e = V.table(spark, d, "events").select("event_id", "ts", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    path = work_path(spark, "bronze-retention")
    write_partitioned(e, path, ["day"], compression="snappy")
    keep_from = (RETENTION_AS_OF.toordinal() - L.RETENTION_DAYS["bronze"])
    L.purge_partitions(spark, path, "day", date.fromordinal(keep_from).isoformat())
    kept = spark.read.parquet(path)
    return L.purge_layer(kept, "bronze", "ts", RETENTION_AS_OF).select("event_id", "ts", "event_type",
                                                                     F.col("day").cast("string").alias("day"))


@query("lay_bucketed", """
SELECT o_orderkey, o_orderpriority, COUNT(*) AS linhas, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantidade
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2""")
def lay_bucketed(spark, d):
    """LAY-6: both sides bucketed by order key (8 buckets or more, by the bytes of the tables, as one
    task joins one bucket): the join and the aggregate on that key run without a shuffle."""
    tag = uuid.uuid4().hex[:8]
    o_name, l_name = f"orders_b_{tag}", f"lineitem_b_{tag}"
    o, li = V.table(spark, d, "orders"), V.table(spark, d, "lineitem")
    buckets = max(8, L.files_for(spark, [*o.inputFiles(), *li.inputFiles()], BUCKET_MB))
    L.save_bucketed(o.select("o_orderkey", "o_orderpriority"), o_name, work_path(spark, "bucketed-orders"), buckets, "o_orderkey")
    L.save_bucketed(li.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity"), l_name,
                    work_path(spark, "bucketed-lineitem"), buckets, "o_orderkey")
    j = spark.table(o_name).join(spark.table(l_name), "o_orderkey")
    return (j.groupBy("o_orderkey", "o_orderpriority")
             .agg(F.count(F.lit(1)).alias("linhas"),
                  money_sum("l_quantity").alias("quantidade")))
