"""The contact graph: replies and shares between users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions.keys import pair_high, pair_low
from starling.operators.dedup import first_rows

# Type codes and their weights in the interaction count.
REPLY, RETWEET = 0, 1
REPLY_WEIGHT, RETWEET_WEIGHT = 2, 1

TARGETS = {REPLY: "reply_to_uid", RETWEET: "retweet_to_uid"}
WEIGHTS = {REPLY: REPLY_WEIGHT, RETWEET: RETWEET_WEIGHT}


def replies(posts: DataFrame) -> DataFrame:
    return posts.where("reply_to_uid IS NOT NULL").drop("retweet_to_uid")


def retweets(posts: DataFrame) -> DataFrame:
    return posts.where("retweet_to_uid IS NOT NULL").drop("reply_to_uid")


def edges(posts: DataFrame, *columns: str) -> DataFrame:
    """One row per contact: sender a, target b, type and weight, with the named columns of the post.

    One scan for both types. A post that is both appears twice.
    """

    def contact(kind: int) -> Column:
        return F.struct(
            F.col("sender_uid").alias("a"),
            F.col(TARGETS[kind]).alias("b"),
            F.lit(kind).alias("type"),
            F.lit(WEIGHTS[kind]).cast("bigint").alias("weight"),
        )

    present = F.filter(F.array(contact(REPLY), contact(RETWEET)), lambda e: e.b.isNotNull())
    linked = posts.where("reply_to_uid IS NOT NULL OR retweet_to_uid IS NOT NULL")
    return linked.select(F.inline(present), *columns)


def unordered(edge_rows: DataFrame) -> DataFrame:
    """Replace a and b by the lower and the higher user."""
    low, high = pair_low(F.col("a"), F.col("b")), pair_high(F.col("a"), F.col("b"))
    return edge_rows.select(low.alias("lo"), high.alias("hi"), *(c for c in edge_rows.columns if c not in ("a", "b")))


def mirror(df: DataFrame, a: str, b: str, self_twice: bool = True) -> DataFrame:
    """Every row in both directions, in one scan. A row of a user with itself comes twice unless told otherwise."""
    there = F.struct(F.col(a).alias("uid"), F.col(b).alias("contact_uid"), F.lit(False).alias("mirrored"))
    back = F.struct(F.col(b).alias("uid"), F.col(a).alias("contact_uid"), F.lit(True).alias("mirrored"))
    ways = F.array(there, back)
    if not self_twice:
        ways = F.when(F.col(a) == F.col(b), F.array(there)).otherwise(ways)
    return df.select(F.inline(ways), *(c for c in df.columns if c not in (a, b))).drop("mirrored")


def pair_counts(contacts: DataFrame, target: str) -> DataFrame:
    """Contacts per unordered pair; counts combine before the shuffle, so a hot pair is one row per task."""
    low, high = pair_low(F.col("sender_uid"), F.col(target)), pair_high(F.col("sender_uid"), F.col(target))
    return contacts.groupBy(low.alias("lo"), high.alias("hi")).agg(F.count("*").alias("cnt"))


def interactions(posts: DataFrame) -> DataFrame:
    """Two per reply and one per share of each unordered pair: one weighted sum over all edges."""
    return unordered(edges(posts)).groupBy("lo", "hi").agg(F.sum("weight").alias("cnt"))


def interactions_by_join(posts: DataFrame) -> DataFrame:
    """The same from the two pair counts by a full outer join."""
    reply = pair_counts(replies(posts), "reply_to_uid").withColumnRenamed("cnt", "reply_count")
    share = pair_counts(retweets(posts), "retweet_to_uid").withColumnRenamed("cnt", "retweet_count")
    zero = F.lit(0)
    return reply.join(share, ["lo", "hi"], "full").select(
        "lo",
        "hi",
        F.coalesce("reply_count", zero).alias("reply_count"),
        F.coalesce("retweet_count", zero).alias("retweet_count"),
        (
            F.coalesce("reply_count", zero) * REPLY_WEIGHT + F.coalesce("retweet_count", zero) * RETWEET_WEIGHT
        ).alias("cnt"),
    )


def contact_posts(posts: DataFrame) -> DataFrame:
    """Posts of each unordered pair, replies and shares alike."""
    return unordered(edges(posts, "tid", "content", "timestamp")).drop("weight")


def latest_contact(posts: DataFrame) -> DataFrame:
    """The latest contact post of each pair; equal times go to the higher tid."""
    order = [F.desc("timestamp"), F.desc("tid"), F.desc("content")]
    return first_rows(contact_posts(posts).drop("type"), ["lo", "hi"], order)


def latest_interaction(latest: DataFrame, counts: DataFrame) -> DataFrame:
    """Latest post and interaction count of each pair."""
    joined = latest.join(counts, ["lo", "hi"], "inner")
    return joined.select("lo", "hi", F.col("content").alias("latest_post"), F.col("cnt").alias("interaction"))


def with_profile(df: DataFrame, users: DataFrame) -> DataFrame:
    """Add the contact's name and description; a missing profile gives empty text."""
    profile = users.select(F.col("uid").alias("contact_uid"), "screen_name", "description")
    joined = df.join(profile, "contact_uid", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit("")) for c in ("screen_name", "description")})
