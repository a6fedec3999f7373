"""What several corpus operators share: the texts of a table, batches of texts, and where copies of a row meet."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import StructField, StructType

# Texts handled together in one step of a task, in characters.
STEP_CHARS = 1 << 20
NO_ID = -(1 << 63)


def text_of(docs: DataFrame) -> Column:
    """The text, where null counts as empty."""
    return F.coalesce(docs["text"], F.lit(""))


def doc_texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, whatever other columns the table has."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))


def keyed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, id, copy and text. Rows that agree in id and copy have the same text; id is doc_id, or NO_ID for null."""
    key = F.coalesce("doc_id", F.lit(NO_ID))
    return doc_texts(docs).select("doc_id", key.alias("id"), F.xxhash64("text").alias("copy"), "text")


def steps(batches: Iterable[pa.RecordBatch], column: str = "text", most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a step holds about STEP_CHARS (or `most`) characters, or one longer text."""
    most = most or STEP_CHARS
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_class: int, max_chars: int
) -> DataFrame:
    """A bounded sample of labelled texts: doc_id, text, label (0 or 1) and weight.

    At most per_class documents of each class are taken, in the order of a hash of the id, and of these the ones with at
    most max_chars characters. Documents whose crc32(doc_id) mod folds is held_out are never used. The weight of a row
    says for how many labelled documents of its class it stands.
    """
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & ~is_held_out(F.col("doc_id"), folds, held_out)).distinct()
    picked = [
        known.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        for value in (0, 1)
    ]
    counts = known.groupBy("label").agg(F.count("*").alias("there"))
    # At most 2 * per_class rows of two numbers.
    chosen = F.broadcast(picked[0].unionByName(picked[1]))
    sample = doc_texts(docs).join(chosen, "doc_id").filter(F.length("text") <= max_chars)
    weight = F.col("there") / F.count("*").over(Window.partitionBy("label"))
    return sample.join(F.broadcast(counts), "label").select("doc_id", "text", "label", weight.alias("weight"))


def filtered_texts(docs: DataFrame, stays: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """The rows of docs, with all columns, whose texts stay. `stays` judges the texts of a step; null comes as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches):
            yield step.filter(pa.array(stays([t or "" for t in step.column("text").to_pylist()])))

    return docs.mapInArrow(run, docs.schema)


def is_held_out(doc_id: Column, folds: int, remainder: int) -> Column:
    """Whether crc32 of the id, written as text, leaves this remainder. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == remainder, F.lit(True))


def keyed_rows(docs: DataFrame, names: list[str] | None = None) -> DataFrame:
    """row (a struct of these columns of docs, or of all), id, copy and text."""
    key = F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("id")
    row = F.struct(*[docs[c] for c in (docs.columns if names is None else names)]).alias("row")
    return docs.select(row, key, text_of(docs).alias("text")).withColumn("copy", F.xxhash64("text"))


def joined_texts(docs: DataFrame, found: DataFrame, column: str, work: Callable, kinds: dict[str, pa.DataType]) -> DataFrame:
    """All rows and columns of docs, and what `work` makes of each text and of what was found for it, or None.

    found has one row for each id and copy (see keyed_texts). New columns replace those of the same name.
    """
    names = [c for c in docs.columns if c not in kinds]
    rows = keyed_rows(docs, names).join(found.select("id", "copy", column), ["id", "copy"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches):
            made = [work(t, x) for t, x in zip(step.column("text").to_pylist(), step.column(column).to_pylist(), strict=True)]
            made = [pa.array(v, kind) for v, kind in zip(zip(*made, strict=True), kinds.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([step.column("row"), *made], names=["row", *kinds])

    row = StructField("row", rows.schema["row"].dataType)
    schema = StructType([row, *[StructField(n, from_arrow_type(k)) for n, k in kinds.items()]])
    out = rows.select("row", "text", column).mapInArrow(run, schema)
    return out.select(*[F.col("row")[c].alias(c) for c in names], *kinds)


def finite_vectors(table: DataFrame, vector: str, others: tuple[str, ...]) -> DataFrame:
    """These other columns, and vector as doubles, of the rows whose vector has neither null nor non-finite components."""
    rows = table.select(*[table[c].alias(c) for c in others], table[vector].cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vector").isNotNull() & finite)


def discard(stored: DataFrame) -> None:
    """Delete what `materialize` has stored for this table, once a later one takes its place."""
    spark = stored.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in stored.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
