"""Places of rows within keys."""

import random

import pytest
from pyspark.sql import functions as F

from starling.operators.documents import add_pages
from starling.operators.positions import with_places


@pytest.mark.parametrize("partitions", [1, 13])
def test_places_equal_those_of_a_sort(spark, partitions):
    rand = random.Random(2)
    listed = [(rand.choice([1, 1, rand.randrange(40)]), rand.choice([None, rand.randrange(9)]), rand.choice("ab")) for _ in range(900)]
    table = spark.createDataFrame(listed, "k long, t long, x string").repartition(partitions)
    found = with_places(table, ["k"], ["t", "x"]).collect()
    assert len(found) == 900
    for key in {r.k for r in found}:
        own = sorted((r for r in found if r.k == key), key=lambda r: r["_place"])
        assert [r["_place"] for r in own] == list(range(len(own)))
        order = [(r.t is not None, r.t or 0, r.x) for r in own]
        assert order == sorted(order)


def test_a_hot_key_of_one_week_is_spread(spark):
    """All rows of one key at one time, and even all alike: tasks hold about as many rows each."""
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for text in (F.col("id").cast("string"), F.lit("same")):
            table = spark.range(20_000).select(F.lit(7).alias("k"), F.lit(5).alias("t"), text.alias("x"))
            placed = with_places(table, ["k"], ["t", "x"])
            assert placed.agg(F.min("_place"), F.max("_place"), F.count_distinct("_place")).first() == (0, 19_999, 20_000)
            ordered = table.withColumn("_tie", F.monotonically_increasing_id()).orderBy("k", "t", "x", "_tie")
            sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
            assert len(sizes) >= 12 and max(sizes) < 3 * 20_000 / 16
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    pages = add_pages(table, ["k"], ["t", "x"], 300).groupBy("part").count().collect()
    assert len(pages) == 67 and all(r["count"] == 300 for r in pages if r["part"] < 66)
