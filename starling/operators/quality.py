"""Checks of tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_numeric(df: DataFrame, column: str) -> DataFrame:
    """Rows whose column holds text that is no whole number."""
    return df.where(F.col(column).isNotNull() & F.col(column).try_cast("bigint").isNull())


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per named table."""
    counted = {name: df.agg(F.count("*").alias("rows")) for name, df in tables.items()}
    return reduce(
        DataFrame.unionByName, (one.select(F.lit(name).alias("name"), "rows") for name, one in counted.items())
    )
