"""Database tables, read in parallel and written in batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: rows per insert batch.
BATCH_ROWS = 50_000

# Column types of a target database that has no types of its own for these.
NUMBER_TYPES = {
    "string": "VARCHAR(2000)",
    "boolean": "NUMERIC(1)",
    "tinyint": "NUMERIC(3)",
    "smallint": "NUMERIC(5)",
    "int": "NUMERIC(10)",
    "bigint": "NUMERIC(19)",
    "float": "NUMERIC(19,4)",
    "double": "NUMERIC(19,4)",
    "binary": "BLOB",
    "timestamp": "TIMESTAMP",
    "date": "DATE",
}


def key_ranges(column: str, lower: int, upper: int, parts: int) -> list[str]:
    """Predicates that cut a numeric key into ranges, one read task each; null keys go with the first."""
    step = max(1, -(-(upper - lower + 1) // parts))
    cuts = [lower + step * i for i in range(1, parts) if lower + step * i <= upper]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def column_types(df: DataFrame, types: dict[str, str] | None = None) -> str:
    """Column type list for table creation, by Spark type; names in `types` win."""
    chosen = types or {}
    pairs = []
    for field in df.schema.fields:
        kind = chosen.get(field.name, NUMBER_TYPES.get(field.dataType.simpleString()))
        if kind:
            pairs.append(f"{field.name} {kind}")
    return ", ".join(pairs)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    predicates: list[str] | None = None,
    custom_schema: str | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A table; filters and columns are pushed to the database. Predicates give one task each (see key_ranges)."""
    options = dict(properties or {})
    if custom_schema:
        options["customSchema"] = custom_schema
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    batch: int = BATCH_ROWS,
    connections: int | None = None,
    types: str | None = None,
    truncate: bool = False,
    properties: dict[str, str] | None = None,
) -> None:
    """Append to or replace a table. `connections` bounds how many tasks write at once, not how many compute.

    A task that is run again after a lost executor may append its rows twice: replace, or load into a staging
    table with a key, where that matters.
    """
    writer = df.repartition(connections).write if connections else df.write
    writer = writer.option("batchsize", batch).option("truncate", truncate)
    if types:
        writer = writer.option("createTableColumnTypes", types)
    writer.jdbc(url, table, mode=mode, properties=properties or {})
