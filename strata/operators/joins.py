"""Joins with explicit size discipline.

* ``broadcast`` is hinted only for a side that the domain keeps small (a series
  catalogue) and whose planned size is within a byte budget. All other joins are
  left to the planner and to AQE, which broadcasts from real shuffle sizes.
* ``salted_join`` spreads every key of the big side over ``n`` salts; ``skew_join`` only the keys that a sketch
  finds hot.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import stable_salt
from strata.functions.util import names

# Budget of a hinted broadcast (Spark's own default threshold is 10 MB).
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's upper estimate of the size of ``df`` (from file sizes; no job runs)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast a side that the domain keeps small, if its planned size agrees; otherwise leave the join to the planner."""
    return F.broadcast(df) if planned_bytes(df) <= max_bytes else df


def enrich(facts: DataFrame, dim: DataFrame, on, how: str = "left", dim_bounded: bool = False) -> DataFrame:
    """Join of a fact with a dimension; the planner and AQE choose from sizes, a bounded dimension is broadcast."""
    return facts.join(bounded_broadcast(dim) if dim_bounded else dim, on=on, how=how)


def anti(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` with no match in ``right``."""
    return left.join(right, on=on, how="left_anti")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Referential-integrity check: child rows whose foreign key has no parent."""
    p = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.join(p, on=child_key, how="left_anti")


def salted_join(big: DataFrame, small: DataFrame, keys, row_id: str, n: int = 16, how: str = "inner") -> DataFrame:
    """Equi-join for skewed keys: the big side gets a stable salt in [0, n) from a hash
    of its row id, the small side is replicated n times (explode of a sequence)."""
    keys = names(keys)
    b = big.withColumn("__salt", stable_salt(row_id, n))
    s = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return b.join(s, on=[*keys, "__salt"], how=how).drop("__salt")


def hot_keys(df: DataFrame, keys, share: float = 0.01) -> list[int]:
    """Hashes of the keys that hold more than ``share`` of the rows, by one pass of a mergeable heavy-hitter sketch.

    Each task keeps a bounded sketch, so nothing is shuffled by key. A key over the share is always found; one a little
    below may be, too. At most 2 / ``share`` numbers come to the driver.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    tracked = 1 << max(6, math.ceil(math.log2(16 / share)))  # the sketch errs by at most 1 / (0.75 * tracked) * 2 of the rows
    found = df.select(F.xxhash64(*[F.col(k) for k in names(keys)]).alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {math.ceil(2 / share)}, {tracked})").alias("top")).first()
    return [t["item"] for t in found["top"] or [] if t["count"] > share * found["n"]]


def skew_join(big: DataFrame, small: DataFrame, keys, row_id, n: int = 16, share: float = 0.01, how: str = "inner",
              hot: list[int] | None = None) -> DataFrame:
    """Equi-join that salts measured hot keys only.

    Rows of ``big`` under a hot key are dealt over ``n`` salts by a hash of ``row_id``; ``small`` is replicated n times
    for hot keys and once for all others, so the replicated rows are n times the hot keys' rows. Which keys are hot changes
    the plan, never the result. ``how``: inner, left (outer), left_semi or left_anti; a right or full join would emit
    an unmatched row of ``small`` once per salt. ``hot``: hashes already known (``hot_keys``), so that no pass over ``big`` is needed.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"a salted join can't be {how}")
    keys = names(keys)
    hot = hot_keys(big, keys, share) if hot is None else hot
    if not hot:
        return big.join(small, on=keys, how=how)
    is_hot = F.xxhash64(*[F.col(k) for k in keys]).isin(hot)
    b = big.withColumn("__salt", F.when(is_hot, stable_salt(row_id, n)).otherwise(0))
    s = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.when(is_hot, n - 1).otherwise(0))))
    return b.join(s, on=[*keys, "__salt"], how=how).drop("__salt")
