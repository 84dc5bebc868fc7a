"""Registered queries: name, operator ids covered, Spark callable and reference SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    ops: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(ops: str, sql: str | None = None):
    """Register a ``(spark, sf_dir) -> DataFrame`` function under its own name."""

    def keep(fn):
        if fn.__name__ in QUERIES:
            raise ValueError(f"query {fn.__name__} registered twice")
        QUERIES[fn.__name__] = Query(fn.__name__, tuple(ops.split()), fn, sql.strip() if sql else None)
        return fn

    return keep
