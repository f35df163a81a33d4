"""Gold aggregates: monthly indicators, expectation vs realized, summaries.

All are plain ``groupBy().agg()`` plans, so Spark does the partial
(map-side) aggregation before the shuffle; no group is ever materialized
as a list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import stable_salt
from strata.functions.money import cents, from_cents, money_sum
from strata.functions.util import as_col, names


def month_of(c) -> Column:
    """First day of the month as DATE."""
    return F.date_trunc("month", as_col(c)).cast("date")


def monthly_indicators(obs: DataFrame, series=("codigo_serie", "nome_serie"), date_col: str = "data_ref",
                       value_col: str = "valor", mean: Column | None = None) -> DataFrame:
    """Per series and month: mean (4 d.p.; ``mean`` replaces it), min, max, close (value at the latest date), count."""
    v = F.col(value_col)
    return (obs.groupBy(*[F.col(s) for s in series], month_of(date_col).alias("mes"))
               .agg((F.round(F.avg(v), 4) if mean is None else mean).alias("valor_medio"),
                    F.min(v).alias("valor_minimo"),
                    F.max(v).alias("valor_maximo"),
                    F.max_by(v, F.col(date_col)).alias("valor_fechamento"),
                    F.count(F.lit(1)).alias("qtd_observacoes")))


def expectation_vs_realized(realized: DataFrame, expected: DataFrame, realized_date: str = "data_ref",
                            realized_value: str = "valor", realized_order=None,
                            expected_month: str = "mes_referencia", expected_value: str = "mediana", code: int | None = None,
                            code_col: str = "codigo_serie", expected_mean: Column | None = None) -> DataFrame:
    """Month grain: last realized value vs mean expected value; surprise = realized - expected.

    ``code`` keeps one series of the realized values. ``realized_order`` (columns) breaks ties among rows
    of the latest date. ``expected_mean`` replaces the rounded mean.
    """
    if code is not None:
        realized = realized.filter(F.col(code_col) == code)
    order = F.struct(*[as_col(c) for c in ([realized_date] + list(realized_order or []))])
    r = (realized.groupBy(month_of(realized_date).alias("mes"))
                 .agg(F.max_by(F.col(realized_value), order).alias("ipca_realizado")))
    e = (expected.groupBy(F.col(expected_month).cast("date").alias("mes"))
                 .agg((F.round(F.avg(expected_value), 4) if expected_mean is None else expected_mean).alias("mediana_focus"),
                      F.count(F.lit(1)).alias("qtd_boletins")))
    j = r.join(e, on="mes", how="full_outer")
    return j.select("mes", "mediana_focus", "ipca_realizado", "qtd_boletins",
                    F.round(F.col("ipca_realizado") - F.col("mediana_focus"), 4).alias("surpresa"))


def approx_and_exact_distinct(df: DataFrame, key: str, col: str, rsd: float = 0.05) -> DataFrame:
    """Per ``key``: ``approx`` (HLL++) and ``exact`` number of distinct non-null values of ``col``.

    Two aggregates joined by key (one row a group): in one, Spark would keep a sketch of some kilobytes for every distinct value.
    """
    approx = df.groupBy(key).agg(F.approx_count_distinct(col, rsd).alias("approx"))
    exact = df.groupBy(key).agg(F.count_distinct(col).alias("exact"))
    return (approx.alias("a").join(exact.alias("e"), F.col(f"a.{key}").eqNullSafe(F.col(f"e.{key}")))
                  .select(F.col(f"a.{key}").alias(key), "approx", "exact"))


def series_summary(obs: DataFrame, key: str = "codigo_serie", date_col: str = "data_ref",
                   value_col: str = "valor", approx: bool = True, rsd: float = 0.05) -> DataFrame:
    """count, exact distinct days, approximate distinct days (HLL++), mean, min, max."""
    exact = obs.groupBy(key).agg(F.count(F.lit(1)).alias("qtd"), F.count_distinct(date_col).alias("dias_exatos"),
                                 F.round(F.avg(value_col), 4).alias("media"), F.min(value_col).alias("min"), F.max(value_col).alias("max"))
    if not approx:
        return exact
    # Apart from the exact count, which would hold a sketch for every day of every key.
    days = obs.groupBy(key).agg(F.approx_count_distinct(date_col, rsd).alias("dias_aprox"))
    return (exact.alias("e").join(days.alias("d"), F.col(f"e.{key}").eqNullSafe(F.col(f"d.{key}")))
                 .select(F.col(f"e.{key}").alias(key), "qtd", "dias_exatos", "dias_aprox", "media", "min", "max"))


def describe_column(df: DataFrame, col: str, exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Long-form summary of one column: count, mean, stddev, min, quartiles, max.

    Quartiles are exact (distributed rank selection, see ``quantiles``) or,
    with ``exact=False``, from Spark's bounded percentile sketch. Never the
    single-task exact ``percentile`` aggregate.
    """
    c = F.col(col)
    stats = ["count", "mean", "stddev", "min", "p25", "p50", "p75", "max"]
    if exact:
        from strata.operators.quantiles import exact_quantiles
        q = exact_quantiles(df, col, [0.25, 0.5, 0.75])
        qcols = [F.lit(v).cast("double") for v in q]
    else:
        qcols = [F.percentile_approx(c, p, accuracy).cast("double") for p in (0.25, 0.5, 0.75)]
    one = df.agg(F.count(c).cast("double").alias("count"), F.avg(c).alias("mean"), F.stddev(c).alias("stddev"),
                 F.min(c).cast("double").alias("min"), *[v.alias(n) for v, n in zip(qcols, ["p25", "p50", "p75"])],
                 F.max(c).cast("double").alias("max"))
    return one.select(F.inline(F.array(*[F.struct(F.lit(s).alias("statistic"), F.col(s).alias("value")) for s in stats])))


def conditional_counts(df: DataFrame, group: list[str], conditions: dict[str, str | Column]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("total")]
    for name, cond in conditions.items():
        aggs.append(F.count_if(F.coalesce(F.expr(cond) if isinstance(cond, str) else cond, F.lit(False))).alias(name))
    return df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)


def salted_aggregate(df: DataFrame, keys, row_id, value: str, salt_buckets: int = 32) -> DataFrame:
    """Two-stage sum/count/min/max (of a 2-decimal money column) for extremely hot keys.

    Stage 1 aggregates by (key, salt) where salt is a stable hash of the row
    id (retries give the same salt); stage 2 merges the partials by key.
    Spark's own partial aggregation already pre-combines per input partition;
    the salt additionally spreads a hot key's shuffle over ``salt_buckets``
    reducers.
    """
    keys = names(keys)
    v = F.col(value)
    partial = (df.withColumn("__salt", stable_salt(row_id, salt_buckets))
                 .groupBy(*keys, "__salt")
                 .agg(F.sum(cents(v)).alias("s"), F.count(v).alias("n"),
                      F.min(v).alias("mn"), F.max(v).alias("mx")))
    return (partial.groupBy(*keys)
                   .agg(from_cents(F.sum("s")).alias("total"), F.sum("n").alias("cnt"),
                        F.min("mn").alias("min_value"), F.max("mx").alias("max_value")))


def rollup_old_detail(df: DataFrame, ts_col: str, as_of, keep_days: int, group: list[str],
                      measures: dict[str, str]) -> DataFrame:
    """Summarize rows older than ``keep_days`` to quarters; keep recent rows at detail grain.

    Output: (period_start DATE, grain 'quarter'|'day', *group, measures..., rows). Rows without a date are left out.
    """
    cutoff = F.date_sub(F.lit(as_of).cast("date"), keep_days)
    d = F.col(ts_col).cast("date")
    old = d < cutoff
    # One scan and one shuffle: the grain is a grouping column.
    return (df.filter(d.isNotNull())
              .groupBy(F.when(old, F.date_trunc("quarter", F.col(ts_col)).cast("date")).otherwise(d).alias("period_start"),
                       F.when(old, F.lit("quarter")).otherwise(F.lit("day")).alias("grain"), *group)
              .agg(*[money_sum(c).alias(n) for n, c in measures.items()], F.count(F.lit(1)).alias("rows")))
