"""Deterministic deduplication.

``dedup_latest`` keeps, per key, the row with the greatest sequence; a NULL
sequence loses to any value; equal sequences are broken by an explicit
tiebreak column (smallest first = "first seen"). It is expressed as
``row_number() = 1`` so Catalyst plans a partial ``WindowGroupLimit`` before
the shuffle: each input partition sends at most one row per key, which keeps a
hot key (even a third of the table) from landing whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.util import as_col, names


def latest_order(seq, tiebreak=None, tiebreak_desc: bool = False) -> list[Column]:
    order = [as_col(seq).desc_nulls_last()]
    for t in ([tiebreak] if isinstance(tiebreak, (str, Column)) else (tiebreak or [])):
        order.append(as_col(t).desc_nulls_last() if tiebreak_desc else as_col(t).asc_nulls_last())
    return order


def top_n_per_key(df: DataFrame, keys, order: list[Column], n: int = 1, rank_col: str | None = None) -> DataFrame:
    """Rows ranked 1..n per key under ``order`` (map-side pre-limited)."""
    rn = "__rn" if rank_col is None else rank_col
    w = Window.partitionBy(*[as_col(k) for k in names(keys)]).orderBy(*order)
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= n)
    return out.drop(rn) if rank_col is None else out


def dedup_latest(df: DataFrame, keys, seq, tiebreak=None, tiebreak_desc: bool = False) -> DataFrame:
    """One row per key: highest ``seq``; NULL seq loses; ties -> smallest tiebreak."""
    return top_n_per_key(df, keys, latest_order(seq, tiebreak, tiebreak_desc), 1)


def drop_duplicates(df: DataFrame, keys=None) -> DataFrame:
    """Spark's dropDuplicates: an arbitrary survivor per key (fine for identical rows)."""
    return df.dropDuplicates(names(keys)) if keys else df.dropDuplicates()
