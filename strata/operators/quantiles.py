"""Exact quantiles by refining a histogram: no sort, and no shuffle of rows.

``F.percentile`` keeps a map of every distinct value and merges all of them in
one final task; on a large continuous column that task holds the column. Here
each round counts the column in ``BINS`` equal parts of the intervals that hold
a wanted rank, with every part's own minimum and maximum; the next round looks
only into the part with the rank, between these two. The extremes of an interval
fall into different parts, so each round gets nearer, and an interval whose
extremes are equal has its value. Every round is one partial aggregation: tasks send
a count per part, the driver gets at most ``BINS`` rows for each interval.

A continuous column takes about log(rows) / log(BINS) rounds, each a scan of this
column alone; an input that isn't a stored table should be written first, as it is
computed in each round. Interpolation follows ``quantile_cont`` / Spark's ``percentile`` (linear
between closest ranks). NaN comes after every number, as in Spark's order.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 4096


def _part(lo: float, hi: float) -> "F.Column":
    """The equal part of [lo, hi] that a value is in; ``hi`` is in the last."""
    half = 1.0 if math.isfinite(hi - lo) else 0.5  # the width of an interval may be beyond the largest number
    share = (F.col("v") * half - lo * half) / (hi * half - lo * half)
    return F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")


def values_at(df: DataFrame, col: str, ranks: set[int], summary: dict) -> dict[int, float]:
    """The values at ``ranks`` (from 0) among the non-null values in rising order; ``summary`` as from ``_summary``."""
    finite = df.select(F.col(col).cast("double").alias("v")).filter(F.abs("v") < float("inf"))
    out, n, below = {}, summary["n"], summary["low"]
    open_at = {}
    for r in ranks:
        if r < below:
            out[r] = -math.inf
        elif r >= n - summary["nan"]:
            out[r] = math.nan
        elif r >= n - summary["nan"] - summary["high"]:
            out[r] = math.inf
        else:
            open_at[r] = (summary["mn"], summary["mx"], below)
    while open_at:
        for r in [r for r, (lo, hi, _) in open_at.items() if lo == hi]:
            out[r] = open_at.pop(r)[0]
        spans = sorted({(lo, hi) for lo, hi, _ in open_at.values()})  # equal or apart
        if not spans:
            break
        inside, part = F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, (lo, hi) in enumerate(spans):
            here = F.col("v").between(lo, hi)
            inside, part = F.when(here, i).otherwise(inside), F.when(here, _part(lo, hi)).otherwise(part)
        counts = (finite.select("v", inside.alias("span"), part.alias("part")).filter("span IS NOT NULL").groupBy("span", "part")
                  .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
        parts = {i: sorted((c for c in counts if c["span"] == i), key=lambda c: c["part"]) for i in range(len(spans))}
        for r, (lo, hi, before) in open_at.items():
            for c in parts[spans.index((lo, hi))]:
                if r < before + c["n"]:
                    open_at[r] = (c["lo"], c["hi"], before)
                    break
                before += c["n"]
    return out


def _summary(df: DataFrame, col: str) -> dict:
    v = F.col(col).cast("double")
    fin = F.when(F.abs(v) < float("inf"), v)
    return df.agg(F.count(v).alias("n"), F.count_if(F.isnan(v)).alias("nan"), F.count_if(v == float("-inf")).alias("low"),
                  F.count_if(v == float("inf")).alias("high"), F.min(fin).alias("mn"), F.max(fin).alias("mx")).first().asDict()


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> list[float | None]:
    """The quantiles of a column; None for a column without values."""
    summary = _summary(df, col)
    n = summary["n"]
    if n == 0:
        return [None for _ in probs]
    places = [((n - 1) * p, math.floor((n - 1) * p), math.ceil((n - 1) * p)) for p in probs]
    at = values_at(df, col, {r for _, lo, hi in places for r in (lo, hi)}, summary)
    return [at[lo] if at[lo] == at[hi] else at[lo] + (h - lo) * (at[hi] - at[lo]) for h, lo, hi in places]
