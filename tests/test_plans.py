"""Physical-plan shape: pushdown, pruning, broadcast only where bounded, map-side
dedup limits, shuffle-free bucketed joins."""

import uuid

from pyspark.sql import functions as F

from strata.operators import layout as L
from strata.operators.dedup import dedup_latest
from strata.plans import views as V
from strata.plans.registry import load_all
from strata.session import work_path
from tests.conftest import SF001


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filter_and_projection_reach_the_scan(spark):
    p = formatted(load_all()["flt_basic"].build(spark, SF001))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in p  # 3 of 6 columns read
    assert "PushedFilters: [IsNotNull(value)]" in p
    r = formatted(load_all()["flt_recent"].build(spark, SF001))
    assert "GreaterThanOrEqual(l_shipdate,2001-04-01T00:00)" in r  # the as-of window folded to a literal
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_shipdate:timestamp_ntz>" in r


def test_dedup_has_partial_window_group_limit_before_shuffle(spark):
    df = dedup_latest(V.table(spark, SF001, "events"), ["user_id"], "ts", "event_id")
    p = formatted(df)
    assert "WindowGroupLimit" in p and "Partial" in p


def test_bounded_dimension_is_broadcast(spark):
    q = load_all()["jon_broadcast_left"].build(spark, SF001)
    assert "BroadcastHashJoin" in formatted(q)


def test_geo_dimension_broadcast_in_star(spark):
    q = load_all()["jon_star"].build(spark, SF001)
    assert "BroadcastHashJoin" in formatted(q)


def test_bucketed_join_has_no_exchange(spark):
    tag = uuid.uuid4().hex[:8]
    o = V.table(spark, SF001, "orders").select("o_orderkey", "o_orderpriority")
    li = V.table(spark, SF001, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    L.save_bucketed(o, f"o_{tag}", work_path(spark, "b-o"), 8, "o_orderkey")
    L.save_bucketed(li, f"l_{tag}", work_path(spark, "b-l"), 8, "o_orderkey")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table(f"o_{tag}").join(spark.table(f"l_{tag}"), "o_orderkey").groupBy("o_orderkey").count()
        assert "Exchange" not in plan(j.select("o_orderkey", "count"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_topk_is_take_ordered(spark):
    q = load_all()["srt_topk"].build(spark, SF001)
    assert "TakeOrderedAndProject" in formatted(q)


def test_no_python_udf_in_any_plan(spark):
    for name in ("agg_monthly", "cdc_scd2", "jon_point_in_time", "exp_parse_brl", "src_rescue", "prv_policy"):
        p = formatted(load_all()[name].build(spark, SF001))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_broadcast_only_within_budget(spark):
    from strata.operators import joins as J
    c = V.table(spark, SF001, "customer")
    small = J.bounded_broadcast(c, max_bytes=10 * 1024 * 1024)
    big = J.bounded_broadcast(c, max_bytes=J.planned_bytes(c) - 1)
    assert "broadcast" in small._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in big._jdf.queryExecution().analyzed().toString().lower()


def test_size_for_input_sets_partitions_from_bytes(spark):
    from strata.session import input_bytes, size_for_input
    paths = [f"{SF001}/lineitem.parquet", f"{SF001}/orders.parquet"]
    assert input_bytes(spark, paths) > 0
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n = size_for_input(spark, paths, partition_mb=1, min_partitions=1)
        assert n >= 1 and spark.conf.get("spark.sql.shuffle.partitions") == str(n)
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "1m"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_flagship_has_two_shuffles(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(load_all()["agg_monthly"].build(spark, SF001))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("Exchange hashpartitioning") == 2  # dedup (map-side limited) + monthly aggregate
    assert "WindowGroupLimit" in p
