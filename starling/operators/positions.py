"""The place of each row among the rows of its key, without bringing a key's rows together in one task.

Rows are sorted by ranges of (key, order), so that a key with many rows lies in several tasks, in order. A task's rows are
numbered as they come and stored; how many rows of a key lie in the tasks before is added, from one count for each key and
task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starling.session import materialize


def with_places(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add _place, from 0, in this order. Rows that agree in it, be they most of a key's, are spread as well."""
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    return places_in_order(tied.orderBy(*keys, *order, "_tie").drop("_tie"), keys)


def places_in_order(ordered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add _place to rows that come sorted as a whole, with the rows of a key one after the other. Keys are never null."""
    stored = materialize(ordered.withColumn("_row", F.monotonically_increasing_id()), "ordered")
    # The upper bits of the number are the task.
    placed = stored.withColumn("_task", F.shiftright("_row", 33))
    counts = placed.groupBy(*keys, "_task").agg(F.count("*").alias("_rows"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    joined = placed.join(counts, [*keys, "_task"])
    place = F.col("_before") + F.col("_row") - F.col("_first")
    return joined.withColumn("_place", place).drop("_row", "_task", "_first", "_before")
