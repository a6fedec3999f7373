"""Concatenated texts per key, in pages.

A document of a hot key could hold a large part of all rows, more than one row, task or string can. So the rows of a
key are numbered in time order and cut into pages of `page_rows` rows; column `part` numbers them from 0, and the pages
of a key, joined in order, are its document. Rows of keys that fill more than a page are numbered by a sort over ranges of
key and time, so no key, and no week of a key, comes together in one task for it; all others have one page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.operators.graph import edges, mirror, replies, retweets, unordered
from starling.operators.positions import with_places
from starling.session import materialize

# Rows in a page.
PAGE_ROWS = 10_000


def add_pages(df: DataFrame, keys: Sequence[str], order: Sequence[str], page_rows: int) -> DataFrame:
    """Add `part`, the page of each row: its place among the rows of its key, by page_rows. Keys are never null."""
    placed = with_places(df, keys, order)
    return placed.withColumn("part", F.floor(F.col("_place") / page_rows).cast("bigint")).drop("_place")


def concatenate(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    page_rows: int = PAGE_ROWS,
    near: Sequence[str] = (),
) -> DataFrame:
    """Comma-joined columns per key and page, in the given order. Keys that agree in `near` lie together (all keys, if none is named).

    Only keys of more rows than a page, which are few, are numbered; the rows of all others are moved once.
    """
    taken = [*order, *(c for c in columns if c not in order)]
    rows = df.select(*keys, *taken).dropna(subset=list(keys))
    many = rows.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > page_rows)
    many = materialize(many.drop("_rows"), "long-keys")

    def joined(column: str):
        return F.array_join(F.transform("_pieces", lambda p: F.coalesce(p[column], F.lit(""))), ",").alias(column)

    def gathered(paged: DataFrame) -> DataFrame:
        # At most page_rows rows.
        pieces = F.array_sort(F.collect_list(F.struct(*taken)))
        return paged.groupBy(*keys, "part").agg(pieces.alias("_pieces")).select(*keys, "part", *map(joined, columns))

    if many.isEmpty():
        return gathered(rows.repartition(*(near or keys)).withColumn("part", F.lit(0).cast("bigint")))
    short = rows.join(many, list(keys), "left_anti").repartition(*(near or keys)).withColumn("part", F.lit(0).cast("bigint"))
    return gathered(short).unionByName(gathered(add_pages(rows.join(many, list(keys), "left_semi"), keys, taken, page_rows)))


_DOC = ("content", "hashtags")
_TIME = ("timestamp", "tid")


def contact_docs(contacts: DataFrame, target: str, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Texts and tags between a user and each contact, in both directions; a post to oneself counts twice."""
    both = mirror(contacts.select("sender_uid", target, *_TIME, *_DOC), "sender_uid", target)
    return concatenate(both, ["uid", "contact_uid"], _TIME, _DOC, page_rows=page_rows)


def reply_docs(posts: DataFrame) -> DataFrame:
    return contact_docs(replies(posts), "reply_to_uid")


def retweet_docs(posts: DataFrame) -> DataFrame:
    return contact_docs(retweets(posts), "retweet_to_uid")


def pair_docs(posts: DataFrame, kind: int, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Texts and tags of each unordered pair for one type."""
    rows = unordered(edges(posts, *_TIME, *_DOC)).where(F.col("type") == kind)
    return concatenate(rows.drop("type", "weight"), ["lo", "hi"], _TIME, _DOC, page_rows=page_rows)


def typed_pair_docs(posts: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Documents of each pair and type, both types in one pass; posts to oneself count twice."""
    rows = unordered(edges(posts, *_TIME, *_DOC)).drop("weight")
    copies = F.when(F.col("lo") == F.col("hi"), 2).otherwise(1)
    doubled = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")
    return concatenate(doubled, ["lo", "hi", "type"], _TIME, _DOC, page_rows=page_rows, near=["lo", "hi"])
