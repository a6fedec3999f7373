"""Lookups, key sets and patches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.functions.keys import split_pair
from starling.operators.graph import REPLY, RETWEET
from starling.session import small_table

# Type words of a request. Any other word means both types.
TYPE_WORDS = {"reply": REPLY, "retweet": RETWEET}


def lookup_contacts(docs: DataFrame, uid: int) -> DataFrame:
    return docs.where(F.col("uid") == uid)


def lookup_contacts_by_type(combined: DataFrame, uid: int, word: str) -> DataFrame:
    rows = combined.where(F.col("uid") == uid)
    return rows.where(F.col("type") == TYPE_WORDS[word]) if word in TYPE_WORDS else rows


def lookup_pairs(df: DataFrame, pairs: Sequence[str]) -> DataFrame:
    """Rows of the listed pair keys. Each key becomes two numbers and the rows are joined to the list."""
    listed = small_table(df.sparkSession, [(p,) for p in pairs], pair=pa.string())
    low, high = split_pair(F.col("pair"))
    return df.join(listed.select(low.alias("lo"), high.alias("hi")).distinct(), ["lo", "hi"], "left_semi")


def filter_range(posts: DataFrame, time_start: int, time_end: int, uid_start: int, uid_end: int) -> DataFrame:
    """Both bounds inclusive."""
    return posts.where(
        F.col("timestamp").between(time_start, time_end) & F.col("sender_uid").between(uid_start, uid_end)
    )


def filter_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is in the key table."""
    return df.join(keys, list(keys.columns), "left_semi")


def patch(df: DataFrame, keys: DataFrame, column: str, value: Column) -> DataFrame:
    """Set a column where the key is listed; a key listed twice applies once."""
    marked = keys.distinct().withColumn("_hit", F.lit(True))
    joined = df.join(marked, list(keys.columns), "left")
    return joined.withColumn(column, F.when(F.col("_hit"), value).otherwise(F.col(column))).select(*df.columns)


def register(spark: SparkSession, frames: Mapping[str, DataFrame]) -> None:
    """Name frames as views for SQL."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def type_of(word: Column) -> Column:
    """Type code of a request word, null for both."""
    chosen = F.when(word == "reply", REPLY)
    return chosen.when(word == "retweet", RETWEET)
