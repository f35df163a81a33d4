"""Expectations (WARN/DROP/FAIL), one-pass metrics, gate, contracts."""

from strata.session import path_exists, work_path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.operators.sinks import NotCertified, certify
from strata.plans import views as V
from strata.plans.q_gold import SILVER_RULES
from tests.conftest import SF001


def test_fail_rule_aborts_before_anything_is_written(spark):
    df = spark.createDataFrame([(1, 5.0), (None, 6.0)], "codigo_serie int, valor double")
    out = work_path(spark, "fail-out")
    with pytest.raises(Exception, match="serie_presente"):
        Q.expect(df, SILVER_RULES).write.parquet(out)
    with pytest.raises(Exception):
        spark.read.parquet(out).count()  # no committed output


def test_fail_sees_rows_that_a_drop_rule_removes(spark):
    """A FAIL violation on a row that a DROP rule also rejects must still abort, even
    when the DROP condition could be pushed into the parquet scan."""
    src = work_path(spark, "fail-src")
    rows = [(1, 10.0)] * 50 + [(None, 1.0)]  # the bad key sits on a row DROP would remove
    spark.createDataFrame(rows, "codigo_serie int, valor double").coalesce(1).write.parquet(src)
    df = spark.read.parquet(src)
    q = Q.expect(df, SILVER_RULES)
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain("formatted")
    pushed = [ln for ln in buf.getvalue().splitlines() if "PushedFilters" in ln]
    assert all("valor" not in ln for ln in pushed)
    with pytest.raises(Exception, match="serie_presente"):
        q.count()


def test_drop_warn_counts_with_observe(spark):
    o = V.obs(spark, SF001)
    obs = Observation("q")
    kept = Q.expect(o, SILVER_RULES, observation=obs).count()
    m = {r["name"]: r for r in Q.observed_metrics(obs, SILVER_RULES, "x")}
    total = o.count()
    assert kept == total - m["valor_valido"]["failed_records"]
    assert m["serie_presente"]["failed_records"] == 0
    assert m["serie_catalogada"]["failed_records"] > 0  # WARN counted, rows kept
    agg = {r["name"]: r["failed_records"] for r in Q.expectation_metrics(o, SILVER_RULES, "x").collect()}
    assert agg == {k: v["failed_records"] for k, v in m.items()}


def test_null_condition_counts_as_violation(spark):
    df = spark.createDataFrame([(None,), (7.0,)], "valor double")
    r = Q.expectation_metrics(df, [Q.Rule("pos", "valor > 0", Q.DROP)], "d").collect()[0]
    assert (r["passed_records"], r["failed_records"]) == (1, 1)
    assert Q.expect(df, [Q.Rule("pos", "valor > 0", Q.DROP)]).count() == 1


def test_gate_and_certification(spark):
    m = spark.createDataFrame([("a", 90, 10), ("b", 100, 0)], "name string, aprovados long, reprovados long")
    row = Q.quality_gate(m).collect()[0]
    assert row["status"] == "ALERTA" and abs(row["rate"] - 0.05) < 1e-9 or row["status"] == "OK"
    assert Q.quality_gate(m, limit=0.01).collect()[0]["status"] == "ALERTA"
    status, rate = Q.gate_verdict(m, limit=0.10)
    assert status == "OK"
    with pytest.raises(NotCertified):
        certify(spark, ["g"], "ALERTA", 0.5, None)
    empty = spark.createDataFrame([], "name string, aprovados long, reprovados long")
    assert Q.quality_gate(empty).collect()[0]["status"] == "OK"
    # unreadable metrics fail closed
    bad = spark.createDataFrame([("x",)], "other string")
    assert Q.gate_verdict(bad)[0] == "ALERTA"


def test_event_log_round_trip(spark):
    o = V.obs(spark, SF001)
    per_day = Q.expectation_metrics(o, SILVER_RULES, "ds", by=["data_ref"])
    back = {r["name"]: (r["aprovados"], r["reprovados"]) for r in Q.metrics_from_event_log(Q.to_event_log(per_day, ["data_ref"])).collect()}
    direct = {r["name"]: (r["passed_records"], r["failed_records"]) for r in Q.expectation_metrics(o, SILVER_RULES, "ds").collect()}
    assert back == direct


def test_contract_detects_duplicates(spark):
    li = V.table(spark, SF001, "lineitem")
    c = Q.Contract({"l_orderkey": ("bigint", False)}, ["l_orderkey", "l_linenumber"], [])
    res = {r["check"]: r["passed"] for r in Q.check_contract(li, c, None).collect()}
    assert res["type:l_orderkey"] is True
    assert res["not_null:l_orderkey"] is True
    assert "unique_key" in res
    dup = V.table(spark, SF001, "orders").unionByName(V.table(spark, SF001, "orders").limit(1))
    c2 = Q.Contract({"o_orderkey": ("bigint", False)}, ["o_orderkey"], [Q.Rule("p", F.col("o_totalprice") > 0)])
    res2 = {r["check"]: r["passed"] for r in Q.check_contract(dup, c2, None).collect()}
    assert res2["unique_key"] is False


def test_medallion_gate_blocks_gold(spark):
    from datetime import datetime

    from strata.plans import medallion as MD
    from strata.sources.landing import TS_FORMAT, land_by_day
    landing = land_by_day(V.table(spark, SF001, "events"), "ts", work_path(spark, "t-landing"), timestampNTZFormat=TS_FORMAT)
    root = work_path(spark, "t-lake")
    for run in ("r1", "r2"):  # the rerun has no new files, but the batches of the first run wait uncertified
        with pytest.raises(MD.GateRejected) as stop:
            MD.run(spark, landing, root, run, datetime(2024, 2, 1), limit=0.01, gate_mode="dropped_rows")
        assert stop.value.status == "ALERTA" and not path_exists(spark, stop.value.gold)
    fresh = MD.run(spark, landing, root, "r3", datetime(2024, 2, 1), limit=0.5, full_refresh=True)
    assert [(r.run_id, r.status) for r in spark.read.parquet(root + "/monitoring/certification").collect()] == [("r3", "OK")]
    assert spark.read.parquet(fresh.gold).count() > 0
    ok = MD.run(spark, landing, work_path(spark, "t-lake2"), "r1", datetime(2024, 2, 1), limit=0.5, gate_mode="violations")
    assert ok.status == "OK" and ok.certification.count() == 1


def test_medallion_rerun_does_not_duplicate(spark):
    from datetime import datetime

    from strata.plans import medallion as MD
    from strata.sources.landing import TS_FORMAT, land_by_day
    landing = land_by_day(V.table(spark, SF001, "events"), "ts", work_path(spark, "t-landing3"), timestampNTZFormat=TS_FORMAT)
    root = work_path(spark, "t-lake3")
    first = MD.run(spark, landing, root, "r1", datetime(2024, 2, 1), limit=0.5)
    g1 = sorted(tuple(r) for r in spark.read.parquet(first.gold).collect())
    bronze1 = spark.read.parquet(root + "/bronze/events").count()
    second = MD.run(spark, landing, root, "r2", datetime(2024, 2, 2), limit=0.5)
    assert spark.read.parquet(root + "/bronze/events").count() == bronze1  # nothing re-ingested
    assert sorted(tuple(r) for r in spark.read.parquet(second.gold).collect()) == g1
