"""The three-feed pipeline: what a drop refreshes, emptied months, rescue, the gate, replays."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from strata.operators.stored import data_files
from strata.plans import lab as L
from strata.session import work_path

AS_OF = datetime(2024, 2, 1)


def land(spark, path, rows):
    spark.createDataFrame([(json.dumps(r),) for r in rows], "value string").coalesce(1).write.mode("append").text(path)


def envelope(code, at, *obs, **more):
    return {"codigo_serie": code, "nome_serie": f"S{code}", "coletado_em": f"{at}T00:00:00.000000", "fonte": "x",
            "observacoes": [{"data": d, "valor": v} for d, v in obs], **more}


def report(at, *values):
    return {"coletado_em": f"{at}T00:00:00.000000", "endpoint": "e", "payload": {"value": [
        {"Indicador": "IPCA", "Data": d, "DataReferencia": m, "Media": 1.0, "Mediana": x, "numeroRespondentes": 3} for d, m, x in values]}}


@pytest.fixture
def feeds(spark):
    return {f: work_path(spark, f"t-lab-{f}") for f in ("sgs", "expectativas")}


def gold(spark, lab, name="indicadores_mensais"):
    return {(r.codigo_serie, r.mes): (r.valor_medio, r.valor_fechamento, r.qtd_observacoes) for r in spark.read.parquet(lab.gold[name]).collect()}


def test_only_touched_months_are_refreshed(spark, feeds):
    root = work_path(spark, "t-lab")
    land(spark, feeds["sgs"], [envelope(433, "2024-01-31", ("30/01/2024", "1,50"), ("31/01/2024", "1.000,25")), envelope(433, "2024-02-02", ("01/02/2024", "2")),
                               envelope(11, "2024-01-31", ("31/01/2024", "7"))])
    land(spark, feeds["expectativas"], [report("2024-01-10", ("2024-01-05", "02/2024", 3.0), ("2024-01-08", "02/2024", 4.0), ("2024-01-08", "03/2024", 5.0))])
    lab, months = L.run(spark, feeds, root, AS_OF)
    assert months == [date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)]
    assert gold(spark, lab) == {(433, date(2024, 1, 1)): (500.875, 1000.25, 2), (433, date(2024, 2, 1)): (2.0, 2.0, 1), (11, date(2024, 1, 1)): (7.0, 7.0, 1)}
    surprise = {r.mes: (r.ipca_realizado, r.mediana_focus, r.qtd_boletins, r.surpresa) for r in spark.read.parquet(lab.gold["expectativa_vs_realizado"]).collect()}
    assert surprise == {date(2024, 1, 1): (1000.25, None, None, None), date(2024, 2, 1): (2.0, 3.5, 2, -1.5), date(2024, 3, 1): (None, 5.0, 1, None)}
    before = set(data_files(spark, lab.gold["indicadores_mensais"]))
    # A correction of February and a late, older collection of January that loses.
    land(spark, feeds["sgs"], [envelope(433, "2024-02-03", ("01/02/2024", "2,5"), ("02/02/2024", "3,5"))])
    lab, months = L.run(spark, feeds, root, AS_OF)
    assert months == [date(2024, 2, 1)]
    changed = before ^ set(data_files(spark, lab.gold["indicadores_mensais"]))
    assert changed and all("mes=2024-02-01" in f for f in changed)
    assert gold(spark, lab)[(433, date(2024, 2, 1))] == (3.0, 3.5, 2)
    assert L.run(spark, feeds, root, AS_OF)[1] == []
    # Random order of the drops, or all at once, gives the same tables.
    again, _ = L.run(spark, feeds, work_path(spark, "t-lab-b"), AS_OF)
    assert gold(spark, again) == gold(spark, lab)
    full, months = L.run(spark, feeds, root, AS_OF, full_refresh=True)
    assert gold(spark, full) == gold(spark, again) and len(months) == 3


def test_a_series_that_moves_out_of_a_month_empties_it(spark, feeds):
    """The month's only row loses its place when the state is corrected; the month vanishes from gold."""
    root = work_path(spark, "t-lab")
    land(spark, feeds["sgs"], [envelope(1, "2024-01-31", ("30/01/2024", "1"), ("10/03/2024", "4"))])
    lab, _ = L.run(spark, feeds, root, AS_OF)
    state = lab.observations
    state.compact(spark)
    from strata.operators import stored as ST
    base = state._current(spark)[0]
    ST.delete_from(spark, base, "mes = DATE'2024-03-01'", ["mes"])
    land(spark, feeds["sgs"], [envelope(1, "2024-04-01", ("11/03/2024", "n/d"), *[(f"{d:02}/01/2024", "1") for d in range(1, 29)])])
    lab, months = L.run(spark, feeds, root, AS_OF)
    assert date(2024, 3, 1) in months and {m for _, m in gold(spark, lab)} == {date(2024, 1, 1)}


def test_rescue_gate_and_retry(spark, feeds):
    root = work_path(spark, "t-lab")
    land(spark, feeds["sgs"], [envelope(1, "2024-01-31", *[(f"{d:02}/01/2024", "1") for d in range(1, 31)], extra={"a": 1})])
    lab, _ = L.run(spark, feeds, root, AS_OF)
    rescued = spark.read.parquet(f"{root}/bronze/sgs").select("_rescued_data").first()[0]
    assert json.loads(rescued) == {"extra": '{"a":1}'}
    was = gold(spark, lab)
    land(spark, feeds["sgs"], [envelope(1, "2024-02-20", *[(f"{d:02}/02/2024", "-5" if d % 2 else "5") for d in range(1, 20)])])
    for _ in range(2):  # a rerun without new files is rejected too
        with pytest.raises(L.GateRejected):
            L.run(spark, feeds, root, AS_OF)
        assert gold(spark, lab) == was
    lab, months = L.run(spark, feeds, root, AS_OF, limit=0.5)
    assert months == [date(2024, 2, 1)] and gold(spark, lab)[(1, date(2024, 2, 1))] == (5.0, 5.0, 9)
    land(spark, feeds["sgs"], [{"nome_serie": "no code", "observacoes": [{"data": "01/01/2024", "valor": "1"}]}])
    with pytest.raises(Exception, match="serie_presente"):
        L.run(spark, feeds, root, AS_OF, limit=0.5)


def test_a_lost_driver_between_silver_and_gold(spark, feeds, monkeypatch):
    root = work_path(spark, "t-lab")
    land(spark, feeds["sgs"], [envelope(433, "2024-01-31", ("30/01/2024", "1,50"))])
    monkeypatch.setattr(L, "to_gold", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        L.run(spark, feeds, root, AS_OF)
    monkeypatch.undo()
    lab, months = L.run(spark, feeds, root, AS_OF)
    assert months == [date(2024, 1, 1)] and gold(spark, lab) == {(433, date(2024, 1, 1)): (1.5, 1.5, 1)}
    assert spark.read.parquet(f"{root}/monitoring/certification").where(F.col("feed") == "sgs").count() == 2
