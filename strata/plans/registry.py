"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules registers their queries.
    from strata.plans import (  # noqa: F401
        q_transform, q_gold, q_cdc, q_quality, q_ingest, q_stream, q_privacy, q_layout, q_lab,
    )
    return REGISTRY
