"""Queries by name, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starling.workload.adapters import Tables
from starling.workload.views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str):
    """Register a function of the tables under a name, with the SQL that gives the same rows."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        ORACLE[name] = with_views(sql)
        return build

    return add
