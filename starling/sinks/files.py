"""Delimited and quoted text, saved tables, table sets, and the lookup layout."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starling.sources.files import SEPARATOR, read_delimited

# A file with multi-line fields is read by one task, so files are kept to this many rows.
ROWS_PER_FILE = 1_000_000


def counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write a table and say how many rows went out, as the writing job itself counts them: nothing is read again.

    A task that runs twice is counted once.
    """
    rows = Observation()
    write(df.observe(rows, F.count(F.lit(1)).alias("rows")))
    return rows.get["rows"]


def write_delimited(
    df: DataFrame, path: str, header: bool = True, encoding: str = "UTF-8", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Replace the separated table at the path."""
    options = {"sep": SEPARATOR, "header": header, "escape": '"', "encoding": encoding}
    df.write.mode("overwrite").options(**options, maxRecordsPerFile=rows_per_file).csv(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Comma table, every field in double quotes."""
    df.write.mode("overwrite").options(quoteAll=True, escape='"', maxRecordsPerFile=ROWS_PER_FILE).csv(path)


def load_delimited(
    spark: SparkSession, path: str, table: str, schema: StructType, header: bool = False, location: str | None = None
) -> None:
    """Append every delimited file of a folder to a table."""
    writer = read_delimited(spark, path, schema, header).write.mode("append").format("parquet")
    (writer.option("path", location) if location else writer).saveAsTable(table)


def load_new_files(spark: SparkSession, path: str, location: str, schema: StructType, header: bool = False) -> DataFrame:
    """Add the delimited files of a folder that have not been loaded yet, and return the whole table.

    Each row keeps its file (path, size and time of change, from the reader's own metadata), so the table itself says what
    has been loaded: files that it names are left out by an anti join. A load is written aside, where readers do not look,
    and comes in by one rename: what a failed load leaves behind is never seen, and the next load takes its files again.
    A file that has changed counts as another one.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(location)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    file = F.struct(*[F.col(f"_metadata.{c}") for c in ("file_path", "file_size", "file_modification_time")])
    rows = read_delimited(spark, path, schema, header).select("*", file.alias("_file"))
    if store.exists(root) and len(store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{location}/load=*"))):
        rows = rows.join(spark.read.parquet(location).select("_file").distinct(), "_file", "left_anti")
    load = uuid.uuid4().hex
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{location}/_load-{load}")
    rows.write.parquet(aside.toString())
    if not store.rename(aside, spark._jvm.org.apache.hadoop.fs.Path(f"{location}/load={load}")):
        raise OSError(f"{aside} cannot be renamed")
    return loaded(spark, location)


def loaded(spark: SparkSession, location: str) -> DataFrame:
    """All rows that `load_new_files` has brought in."""
    return spark.read.parquet(location).drop("_file", "load")


def save_table(df: DataFrame, name: str, location: str | None = None) -> None:
    """Replace a table by a result."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", location) if location else writer).saveAsTable(name)


def export_tables(tables: Mapping[str, DataFrame], path: str) -> None:
    """Dump a set of named tables below one folder."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def restore_tables(spark: SparkSession, names: Iterable[str], path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}


def write_serving(df: DataFrame, path: str, keys: list[str], parts: int | None = None) -> None:
    """Lay a table out for lookups by its first keys.

    Rows are range partitioned and sorted, so a lookup skips all files and row groups whose bounds exclude the
    key. Name the whole row key: the trailing keys let a hot leading key spread over several files.
    """
    ranged = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
