"""The reference's pure-function cases, run as Spark Column expressions."""

from datetime import date

from pyspark.sql import functions as F

from strata.functions.parsing import is_catalogued, latest_observation, parse_brl, parse_date_br, parse_month_br


def one_col(spark, values, ddl, expr):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(expr(F.col(df.columns[0]))).collect()]


def test_parse_brl_formats(spark):
    got = one_col(spark, ["4.90", "1.234,56", "12,5", None, "", "abc", " 7 ", "1.0d", "-3,25", "1e3"], "s string", parse_brl)
    assert got == [4.9, 1234.56, 12.5, None, None, None, 7.0, None, -3.25, 1000.0]


def test_parse_date_br(spark):
    got = one_col(spark, ["01/07/2026", "31/02/2026", None, "1/7/2026", "01/07/26", " 03/12/2025 ", "xx"], "s string",
                  parse_date_br)
    assert got == [date(2026, 7, 1), None, None, date(2026, 7, 1), None, date(2025, 12, 3), None]


def test_parse_month_br(spark):
    assert one_col(spark, ["07/2026", "13/2026", None], "s string", parse_month_br) == [date(2026, 7, 1), None, None]


def test_is_catalogued(spark):
    got = one_col(spark, ["11", "433", "9999", "x", None, " 1 ", "+11", "4.0"], "s string", is_catalogued)
    assert got == [True, True, False, False, False, True, True, False]
    assert one_col(spark, [11, 9999], "n int", is_catalogued) == [True, False]


def test_latest_observation(spark):
    df = spark.createDataFrame(
        [([("01/07/2026", "1"), ("03/07/2026", "3"), ("xx", "9")],), ([],), (None,),
         ([("02/07/2026", "a"), ("02/07/2026", "b")],)],
        "a array<struct<data:string,valor:string>>")
    got = [r[0] for r in df.select(latest_observation("a")["valor"]).collect()]
    assert got == ["3", None, None, "a"]  # ties: the first element wins
