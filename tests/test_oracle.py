"""Every registered query against its DuckDB oracle on sf0.001 (the driver does the same at sf0.01)."""

import os
import sys

import duckdb
import pytest

from tests.conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))
from oracle_check import rows_key  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from strata.plans.registry import load_all  # noqa: E402
from strata.plans.views import TABLES  # noqa: E402

SQL = E.oracle_sql()
OWN = sorted(load_all())  # the text operators' queries are tested in tests/llm


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(SQL) and set(OWN) <= set(E.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert forbidden not in plan, f"{name}: {forbidden} in plan"
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.execute(SQL[name])
    d_cols = [x[0] for x in rel.description]
    d_rows = rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_key(s_cols, s_rows) == rows_key(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["codigo_serie", "nome_serie", "mes", "valor_medio", "valor_minimo", "valor_maximo",
                          "valor_fechamento", "qtd_observacoes"]
