"""Keys at evenly spaced ranks of a sorted key column, without sorting in one task.

Keys are counted first and stored, so a hot key is one row and the input is read once. A few cut keys, taken from a
sample and put into the plan as literals, divide the keys into ordered buckets; they decide the balance of the work and
not the result. Bucket totals give each bucket its first rank, and only ranks within a bucket are windowed.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starling.session import materialize, small_table

# Keys drawn to choose the cuts.
SAMPLE_KEYS = 20_000


def _cuts(keys: DataFrame, buckets: int) -> list:
    total = keys.count()
    fraction = min(1.0, SAMPLE_KEYS / max(total, 1))
    drawn = sorted(row.key for row in keys.sample(fraction=fraction, seed=7).collect())
    step = max(1, len(drawn) // buckets)
    return sorted(set(drawn[step::step]))


def split_points(df: DataFrame, key: str, parts: int, buckets: int | None = None) -> DataFrame:
    """For i in 1..parts-1 the rank round(i * N / parts) and the key at that rank, ranks from 1.

    There is one bucket per shuffle partition. Only buckets that hold a wanted rank, at most parts - 1, are ranked.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))
    counted = materialize(keys, "keys")
    cuts = _cuts(counted.select("key"), buckets)
    bucket = F.lit(0)
    if cuts:
        bounds = F.array(*[F.lit(c) for c in cuts])
        bucket = F.size(F.filter(bounds, lambda bound: bound <= F.col("key")))
    placed = counted.withColumn("bucket", bucket)

    totals = {r.bucket: r.n for r in placed.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    rows = sum(totals.values())
    targets, before = [], 0
    wanted = [(2 * i * rows + parts) // (2 * parts) for i in range(1, parts)]
    for number in sorted(totals):
        targets += [(number, rank, rank - before) for rank in wanted if before < rank <= before + totals[number]]
        before += totals[number]

    ordered = Window.partitionBy("bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    held = sorted({number for number, _, _ in targets})
    ranked = placed.where(F.col("bucket").isin(held)).withColumn("last", F.sum("n").over(ordered)).withColumn("first", F.col("last") - F.col("n") + 1)
    asked = small_table(df.sparkSession, targets, bucket=pa.int32(), rank=pa.int64(), local=pa.int64())
    hit = ranked.join(F.broadcast(asked), "bucket").where(F.col("local").between(F.col("first"), F.col("last")))
    return hit.select("rank", F.col("key").alias("split_key"))
