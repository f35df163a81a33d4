"""What one task holds doesn't follow the whole table: sketches, buckets, groups before a distinct count."""

import uuid

from pyspark.sql import functions as F

from strata.operators import aggregates as A
from strata.operators import gold as G
from strata.operators import layout as L
from strata.operators.stored import data_files
from strata.plans import q_layout
from strata.session import work_path


def physical(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_no_sketch_for_every_distinct_value(spark):
    rows = [("a", i % 40) for i in range(200)] + [("b", None), ("b", 7), ("b", 7), (None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "k string, u long")
    got = A.approx_and_exact_distinct(df, "k", "u", 0.02)
    assert {r.k: (r.approx, r.exact) for r in got.collect()} == {"a": (40, 40), "b": (1, 1), None: (2, 2)}
    obs = spark.createDataFrame([("a", i % 5, float(i)) for i in range(20)] + [(None, 1, 2.0), (None, None, 4.0)], "codigo_serie string, data_ref int, valor double")
    summary = A.series_summary(obs)
    assert summary.columns == ["codigo_serie", "qtd", "dias_exatos", "dias_aprox", "media", "min", "max"]
    assert {tuple(r) for r in summary.collect()} == {("a", 20, 5, 5, 9.5, 0.0, 19.0), (None, 2, 1, 1, 3.0, 2.0, 4.0)}
    for q in (got, summary):  # an aggregate with a sketch is grouped by the key alone
        sketches = [line for line in physical(q).splitlines() if "Aggregate(" in line and "approx_count_distinct" in line]
        assert sketches and all(line.split("keys=[")[1].split("]")[0].count("#") == 1 for line in sketches)


def test_buckets_follow_the_input_and_are_one_file_each(spark, tmp_path, monkeypatch):
    path, name = work_path(spark, "t-buckets"), f"t_{uuid.uuid4().hex[:8]}"
    L.save_bucketed(spark.range(0, 500, 1, 6).withColumn("id", F.expr("nullif(id, 3)")), name, path, 4, "id")
    assert len(data_files(spark, path)) == 4 and spark.table(name).count() == 500
    d, asked = str(tmp_path), []
    spark.range(2000).selectExpr("nullif(id % 1500, 7) AS o_orderkey", "CAST(uuid() AS STRING) AS o_orderpriority").write.parquet(f"{d}/orders.parquet")
    spark.range(9000).selectExpr("id % 1600 AS l_orderkey", "rand() AS l_quantity").selectExpr(
        "l_orderkey", "round(l_quantity, 2) AS l_quantity").write.parquet(f"{d}/lineitem.parquet")
    save = L.save_bucketed
    monkeypatch.setattr(L, "save_bucketed", lambda df, t, p, n, key: (asked.append(n), save(df, t, p, n, key)))
    monkeypatch.setattr(L, "files_for", lambda spark, paths, mb: len(paths))  # more input, more buckets
    got = q_layout.lay_bucketed(spark, d)
    files = sum(len(spark.read.parquet(f"{d}/{t}.parquet").inputFiles()) for t in ("orders", "lineitem"))
    assert asked == [max(8, files)] * 2 and files > 8
    o, li = spark.read.parquet(f"{d}/orders.parquet"), spark.read.parquet(f"{d}/lineitem.parquet")
    want = o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderkey", "o_orderpriority").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    key = lambda r: (r[0], r[1], r[2], round(r[3], 6))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def test_lines_are_dealt_to_tasks_by_input_before_orders_are_counted(spark, tmp_path, monkeypatch):
    rows = [("2024-01-01", "EU", "x", 1, 1.25), ("2024-01-01", "EU", "x", 1, 2.0), ("2024-01-01", "EU", "x", 2, 3.0), ("2024-01-01", None, None, 2, 1.0),
            ("2024-01-01", None, None, None, 4.0), ("2024-01-02", "EU", "x", 1, 5.0)]
    spark.createDataFrame(rows, "order_date string, region string, category string, order_key long, revenue double").write.parquet(f"{tmp_path}/star")
    lines = spark.read.parquet(f"{tmp_path}/star")
    monkeypatch.setattr(G, "files_for", lambda spark, paths, mb: 370 if paths else 0)
    got = G.daily_revenue(lines)
    assert {tuple(r) for r in got.collect()} == {("2024-01-01", "EU", "x", 3, 6.25, 2.08, 2), ("2024-01-01", None, None, 2, 5.0, 2.5, 1), ("2024-01-02", "EU", "x", 1, 5.0, 5.0, 1)}
    exchanges = [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]
    assert any(", 370)" in x for x in exchanges if "order_key" in x)
