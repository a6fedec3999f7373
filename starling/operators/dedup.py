"""One row per key, by a total order, so that a re-run after a lost executor gives the same row.

Each task keeps one row per key before the shuffle (row_number() = 1 is a group limit in the plan), so a key that
holds a large part of all rows sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starling.session import materialize


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of each key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def newest_first(df: DataFrame, keys: Sequence[str], lead: Sequence[str] = ("timestamp",)) -> list:
    """Total order: leading columns, then all others, highest first."""
    rest = [c for c in df.columns if c not in keys and c not in lead]
    return [F.col(c).desc_nulls_last() for c in (*lead, *rest)]


def dedup_posts(posts: DataFrame) -> DataFrame:
    """One post per tid, the latest copy."""
    return first_rows(posts, ["tid"], newest_first(posts, ["tid"]))


def latest_profiles(user_mid: DataFrame) -> DataFrame:
    """The latest profile of each user; equal times go to the highest name, then description."""
    return first_rows(user_mid, ["uid"], newest_first(user_mid, ["uid"]))


def distinct_users(df: DataFrame) -> DataFrame:
    """One row per user whatever its time, the lowest of all rows."""
    order = [F.col(c).asc_nulls_last() for c in df.columns if c != "uid"]
    return first_rows(df, ["uid"], order)


def latest_rows(df: DataFrame) -> DataFrame:
    """All rows at the latest time of their user, ties included.

    A maximum per user joined back on user and time: the maximum combines before the shuffle, and the rows of a
    hot user spread by time.
    """
    latest = df.groupBy("uid").agg(F.max("timestamp").alias("timestamp"))
    return df.join(latest, ["uid", "timestamp"], "left_semi")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).where("count > 1")


def duplicate_rows(posts: DataFrame) -> DataFrame:
    """All rows whose tid occurs more than once."""
    return posts.join(duplicates(posts, ["tid"]).select("tid"), "tid", "left_semi").select(*posts.columns)


def duplicate_survivors(posts: DataFrame) -> DataFrame:
    """Of each duplicated tid, the row that is kept."""
    return dedup_posts(duplicate_rows(posts))


def dedup_by_replacement(posts: DataFrame) -> DataFrame:
    """Remove the rows of duplicated tids and add one survivor each. Same rows as dedup_posts, which is cheaper."""
    repeated = duplicates(posts, ["tid"]).select("tid")
    single = posts.join(repeated, "tid", "left_anti").select(*posts.columns)
    return single.unionByName(duplicate_survivors(posts))


def row_ids(posts: DataFrame) -> DataFrame:
    """Number the copies of each duplicated tid from 1.

    The rows are stored first, so their place in the files is fixed. Each split of the files numbers its own rows of
    a tid and the counts of the splits before are added: a tid with very many copies is never in one task.
    """
    stored = materialize(duplicate_rows(posts), "duplicates")
    placed = stored.withColumn("_at", F.monotonically_increasing_id()).withColumn("_split", F.shiftright("_at", 33))
    counts = placed.groupBy("tid", "_split").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("tid").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("tid", "_split", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("tid", "_split").orderBy("_at"))
    numbered = placed.withColumn("_local", within).join(before, ["tid", "_split"])
    return numbered.select((F.col("_before") + F.col("_local")).alias("row_id"), *posts.columns)
