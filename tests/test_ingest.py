"""Ingestion semantics: rescue, schema evolution modes, COPY INTO, availableNow reruns, layout jobs."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import layout as L
from strata.operators.sinks import write_partitioned
from strata.plans import views as V
from strata.session import work_path
from strata.sources import files as SF
from strata.sources import rescue as R
from strata.sources.landing import land
from tests.conftest import SF001

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])


def test_rescue_unknown_fields_wrong_types_and_corrupt_text(spark):
    df = spark.createDataFrame([('{"a": 1, "b": 2.5}',), ('{"a": 2, "b": "x", "c": true}',), ("not json",), ('[1,2]',)],
                               "text string")
    got = R.read_rescued(df, "text", SCHEMA, keep_map=True).orderBy("a").collect()
    rows = {(r["a"], r["b"], r[R.RESCUED] is not None, r[R.CORRUPT]) for r in got}
    assert (1, 2.5, False, False) in rows
    assert (2, None, True, False) in rows
    assert sum(1 for r in got if r[R.CORRUPT]) == 2  # kept, flagged for quarantine
    r2 = [r for r in got if r["a"] == 2][0]
    assert r2["_rescued_map"] == {"b": "x", "c": "true"}


def test_schema_evolution_modes(spark):
    landing = work_path(spark, "t-evolve")
    base = V.table(spark, SF001, "events").select("event_id", "value")
    land(base, landing + "/g=1", "json")
    sp = work_path(spark, "t-schema")
    first = R.evolve_schema(spark, landing, sp)
    assert "props" not in first.fieldNames()
    land(V.table(spark, SF001, "events").select("event_id", "value", "props"), landing + "/g=2", "json")
    assert "props" not in R.evolve_schema(spark, landing, sp, mode="none").fieldNames()
    assert "props" not in R.evolve_schema(spark, landing, sp, mode="rescue").fieldNames()
    with pytest.raises(R.NewColumnsRejected):
        R.evolve_schema(spark, landing, sp, mode="failOnNewColumns")
    with pytest.raises(R.SchemaEvolved):
        R.evolve_schema(spark, landing, sp)
    assert "props" in R.evolve_schema(spark, landing, sp).fieldNames()  # rerun continues wider


def test_copy_into_is_idempotent_per_file(spark):
    o = V.table(spark, SF001, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy").alias("ano"))
    landing = land(o, work_path(spark, "t-copy"), "parquet", partition_by=["ano"])
    target = work_path(spark, "t-copy-target")
    assert SF.load_new_files(spark, landing, "parquet", target) == o.count()
    assert SF.load_new_files(spark, landing, "parquet", target) == 0
    assert SF.read_target(spark, target).count() == o.count()


def test_hot_partition_value_is_split_across_files(spark):
    e = V.table(spark, SF001, "events")
    hot = e.withColumn("day", F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.date_format("ts", "yyyy-MM-dd")))
    path = work_path(spark, "t-hot")
    write_partitioned(hot, path, ["day"], compression="snappy")
    files = spark.read.parquet(path).filter(F.col("day") == "hot").select("_metadata.file_path").distinct().count()
    assert files > 1
    assert spark.read.parquet(path).count() == e.count()


def test_read_layer_batch_and_stream(spark):
    path = work_path(spark, "t-layer")
    V.table(spark, SF001, "nation").write.parquet(path)
    assert SF.read_layer(spark, path).count() == 25
    assert SF.read_layer(spark, path, stream=True).isStreaming


def test_compaction_reduces_files_and_keeps_rows(spark):
    src = work_path(spark, "t-small")
    V.table(spark, SF001, "lineitem").repartition(40).write.parquet(src)
    dst = L.compact(spark, src, work_path(spark, "t-big"), target_mb=64)
    assert L.file_count(spark, dst) < L.file_count(spark, src)
    assert spark.read.parquet(dst).count() == spark.read.parquet(src).count()


def test_analyze_table_statistics(spark):
    name = "t_stats_" + work_path(spark, "x")[-8:].replace("-", "_")
    V.table(spark, SF001, "nation").write.option("path", work_path(spark, "t-stats")).saveAsTable(name)
    L.analyze(spark, name, ["n_nationkey"])
    desc = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name} n_nationkey").collect()}
    assert desc.get("distinct_count") == "25"


def test_refresh_partitions_keeps_untouched_files(spark):
    from strata.operators import sinks as S
    e = V.table(spark, SF001, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    agg = lambda df: df.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    path = work_path(spark, "t-refresh")
    S.write_partitioned(agg(e), path, ["day"], compression="snappy")

    def files():
        return {(r["day"], r["f"]) for r in spark.read.parquet(path)
                .select(F.col("day").cast("string").alias("day"), F.col("_metadata.file_path").alias("f")).distinct().collect()}
    before = files()
    S.refresh_partitions(spark, path, e.filter(F.col("day") == "2024-01-05"), ["day"], agg)
    after = files()
    assert {d for d, _ in before ^ after} == {"2024-01-05"}
    assert spark.read.parquet(path).count() == len({d for d, _ in before})


def test_refresh_partitions_drops_emptied_groups(spark):
    from strata.operators import sinks as S
    from strata.operators.stored import data_files
    rows = [("2024-01", 1, 5), ("2024-01", 2, 7), ("2024-02", 3, 9), ("2024-03", 4, 2), (None, 5, 1)]
    src = spark.createDataFrame(rows, "mes string, k int, v int")
    good = lambda df: df.filter("v >= 5 or mes is null").groupBy("mes").agg(F.sum("v").alias("s"))
    path = work_path(spark, "t-emptied")
    S.write_partitioned(good(src), path, ["mes"])
    before = set(data_files(spark, path))
    # February's row is corrected below the limit, January gets another row: March had none and has none.
    now = spark.createDataFrame([("2024-01", 1, 5), ("2024-01", 2, 7), ("2024-01", 6, 8), ("2024-02", 3, 1), ("2024-03", 4, 2)], "mes string, k int, v int")
    touched = spark.createDataFrame([("2024-01",), ("2024-02",), ("2024-03",)], "mes string")
    for _ in range(2):
        S.refresh_partitions(spark, path, now, ["mes"], good, touched)
        got = {(None if r.mes is None else str(r.mes)[:7]): r.s for r in spark.read.parquet(path).collect()}
        assert got == {"2024-01": 20, None: 1}
    assert {f for f in before if "DEFAULT" in f} <= set(data_files(spark, path))
    S.refresh_partitions(spark, path, now.limit(0), ["mes"], good, spark.createDataFrame([("2024-01",)], "mes string"))
    assert [r.s for r in spark.read.parquet(path).collect()] == [1]


def test_streams_over_two_months_lose_nothing(spark):
    from strata.plans.registry import load_all
    root = work_path(spark, "two-months")
    e = V.table(spark, SF001, "events")
    later = e.withColumns({"event_id": F.col("event_id") + 10 ** 9, "ts": F.col("ts") + F.expr("INTERVAL 40 DAYS")})
    e.unionByName(later).write.parquet(f"{root}/events.parquet")
    queries = load_all()
    assert queries["str_dedup"].build(spark, root).count() == 2 * e.count()
    hourly = queries["str_stream_hourly"].build(spark, root).agg(F.sum("eventos")).first()[0]
    end = later.agg(F.max("ts").alias("t")).select(F.date_trunc("hour", F.col("t") - F.expr("INTERVAL 10 MINUTES")).cast("timestamp_ntz")).first()[0]
    closed = e.unionByName(later).where(F.col("ts") < F.lit(end).cast("timestamp_ntz")).count()
    assert hourly == closed


def test_copy_into_opens_only_new_files(spark):
    """A second run lists names only: files that are loaded may have become unreadable."""
    import os
    from strata.operators.stored import data_files
    o = V.table(spark, SF001, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy").alias("ano"))
    landing, target = work_path(spark, "t-copy-landing"), work_path(spark, "t-copy")
    o.filter("ano < '1998'").write.partitionBy("ano").json(landing)
    n = SF.load_new_files(spark, landing, "json", target, "o_orderkey long")
    assert n == o.filter("ano < '1998'").count()
    for f in data_files(spark, landing):
        with open(f.removeprefix("file:"), "w") as out:
            out.write('{"o_orderkey": -1}\n')
        crc = os.path.join(os.path.dirname(f.removeprefix("file:")), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    assert SF.load_new_files(spark, landing, "json", target, "o_orderkey long") == 0
    o.filter("ano >= '1998'").write.mode("append").partitionBy("ano").json(landing)
    SF.load_new_files(spark, landing, "json", target, "o_orderkey long")
    got = SF.read_target(spark, target)
    assert got.count() == o.count() and got.filter("o_orderkey = -1").count() == 0
    assert sorted(r.ano for r in got.select("ano").distinct().collect()) == sorted(int(r.ano) for r in o.select("ano").distinct().collect())


@pytest.mark.parametrize("at", ["load", "ledger"])
def test_copy_into_after_a_lost_driver(spark, at, monkeypatch):
    landing, target = work_path(spark, "t-copy2-landing"), work_path(spark, "t-copy2")
    spark.range(100).repartition(3).write.json(landing)
    name = "_note_loaded" if at == "ledger" else "Observation"
    monkeypatch.setattr(SF, name, lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        SF.load_new_files(spark, landing, "json", target, "id long")
    monkeypatch.undo()
    assert SF.load_new_files(spark, landing, "json", target, "id long") == (0 if at == "ledger" else 100)
    assert SF.load_new_files(spark, landing, "json", target, "id long") == 0
    assert SF.read_target(spark, target).count() == 100


def test_rescue_enters_arrays_and_maps(spark):
    from pyspark.sql import types as T
    schema = T._parse_datatype_string("a INT, items ARRAY<STRUCT<v INT>>, ctx STRUCT<u STRING, deep ARRAY<ARRAY<INT>>>, m MAP<STRING, STRUCT<k INT>>")
    cases = {
        '{"items":[{"v":"abc","x":9},{"v":1}]}': {"items[0].v": "abc", "items[0].x": "9"},
        '{"items":[{"v":1},{"v":2,"y":{"z":[1]}}],"zz":true}': {"items[1].y": '{"z":[1]}', "zz": "true"},
        '{"a":1,"m":{"p":{"k":1,"w":"more"}},"ctx":{"u":"q","new":[1,2]}}': {"m.p.w": "more", "ctx.new": "[1,2]"},
        '{"a":null,"items":null,"ctx":{}}': {},
        '{"items":"text"}': {"items": "text"},
        "[1]": None, "": None, "nope": None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "text string").withColumn("t", F.col("text"))
    out = R.read_rescued(df, "text", schema, keep_map=True)
    for r in out.collect():
        assert r["_rescued_map"] == cases[r.t] and r["_corrupt"] == (cases[r.t] is None)
        assert (r["_rescued_data"] is None) == (not cases[r.t])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") <= 1 and plan.count("parse_json") <= 1
