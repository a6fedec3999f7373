"""Posts as JSON lines, delimited tables, and term lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from starling.schemas import RAW_POST

# Fixed value: the separator of delimited tables; post text holds commas and line breaks.
SEPARATOR = "⊢"

# Stands for quoted empty text while a file is read, which Spark would give as null.
_EMPTY = "\ue000\ue001"

# More terms than this do not go into an expression or to the driver.
MAX_TERMS = 10_000


def read_posts(spark: SparkSession, path: str | list[str], parts: int | None = None) -> DataFrame:
    """Raw posts, one JSON object per line, plain or compressed; path, glob or list of them.

    The schema is given, so there is no extra pass to infer it and only the named fields are parsed. A line that
    is no JSON object becomes a row of nulls, which the validity filters drop. A compressed file is one task;
    `parts` spreads its rows for the work behind.
    """
    raw = spark.read.schema(RAW_POST).option("mode", "PERMISSIVE").json(path)
    return raw.repartition(parts) if parts else raw


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    header: bool = True,
    required: list[str] | None = None,
) -> DataFrame:
    """A separated table with multi-line fields.

    Without a schema the types are inferred, which costs a pass over the data. Files give nullable columns
    whatever the schema says, so columns that must be present are named in `required`. A field with nothing in it is
    null and a pair of quotes is empty text.
    """
    options = {"sep": SEPARATOR, "header": header, "multiLine": True, "escape": '"', "emptyValue": _EMPTY}
    reader = spark.read.options(**options, encoding="UTF-8")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    read = reader.csv(path)
    texts = [f.name for f in read.schema.fields if f.dataType == StringType()]
    table = read.withColumns({c: F.when(F.col(c) == _EMPTY, "").otherwise(F.col(c)) for c in texts})
    return table.dropna(subset=required) if required else table


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """Distinct lower-cased terms of a text file, one per line."""
    return spark.read.text(path).select(F.lower("value").alias("term")).distinct()


def term_list(terms: DataFrame, limit: int = MAX_TERMS) -> list[str]:
    """The terms as a list for use inside an expression.

    Longer lists stay tables: operators.terms does the same with a table of any size, and the plans take either.
    """
    rows = terms.select("term").where("term IS NOT NULL").distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} terms; join the table instead")
    return sorted(row.term for row in rows)
