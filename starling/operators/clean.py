"""From raw posts to clean posts, topic posts and profile rows. Narrow steps: one stage, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.keys import parse_time, prefer_text_id
from starling.functions.text import join_tags
from starling.schemas import POST, TOPIC_POST

# Languages kept.
LANGUAGES = ("ar", "en", "fr", "in", "pt", "es", "tr", "ja")
TOPIC_LANGUAGES = ("en",)

PROFILE_COLUMNS = ("sender_screen_name", "sender_description", "retweet_to_screen_name", "retweet_to_description")


def project_posts(raw: DataFrame) -> DataFrame:
    """Pick and flatten the fields of a post."""
    return raw.select(
        F.col("id").alias("tid"),
        F.col("id_str").alias("tid_str"),
        parse_time(F.col("created_at")).alias("timestamp"),
        F.col("text").alias("content"),
        F.col("in_reply_to_user_id").alias("reply_to_uid"),
        F.col("in_reply_to_user_id_str").alias("reply_to_uid_str"),
        F.col("user.id").alias("sender_uid"),
        F.col("user.id_str").alias("sender_uid_str"),
        F.col("user.screen_name").alias("sender_screen_name"),
        F.col("user.description").alias("sender_description"),
        F.col("retweeted_status.user.id").alias("retweet_to_uid"),
        F.col("retweeted_status.user.id_str").alias("retweet_to_uid_str"),
        F.col("retweeted_status.user.screen_name").alias("retweet_to_screen_name"),
        F.col("retweeted_status.user.description").alias("retweet_to_description"),
        join_tags(F.col("entities.hashtags.text")).alias("hashtags"),
        F.col("lang"),
    )


def project_topic_posts(raw: DataFrame) -> DataFrame:
    """Pick the fields of a topic post with its engagement counts."""
    return raw.select(
        F.col("id").alias("tid"),
        F.col("id_str").alias("tid_str"),
        parse_time(F.col("created_at")).alias("timestamp"),
        F.col("text").alias("content"),
        F.col("user.id").alias("sender_uid"),
        F.col("user.id_str").alias("sender_uid_str"),
        F.col("user.followers_count").alias("followers_count"),
        F.col("favorite_count"),
        F.col("retweet_count"),
        F.col("lang"),
    )


def filter_valid_topic(df: DataFrame, langs: Sequence[str] = TOPIC_LANGUAGES) -> DataFrame:
    """Posts in an accepted language with an id, a sender, a time and a text. Empty text is kept."""
    return df.where(
        F.col("lang").isin(*langs)
        & (F.col("tid").isNotNull() | F.col("tid_str").isNotNull())
        & (F.col("sender_uid").isNotNull() | F.col("sender_uid_str").isNotNull())
        & F.col("timestamp").isNotNull()
        & F.col("content").isNotNull()
    )


def filter_valid(df: DataFrame, langs: Sequence[str] = LANGUAGES) -> DataFrame:
    """The same with at least one hashtag."""
    return filter_valid_topic(df, langs).where(F.length("hashtags") > 0)


def coalesce_ids(df: DataFrame) -> DataFrame:
    """Fold every id column and its text form into one number."""
    names = [c.removesuffix("_str") for c in df.columns if c.endswith("_str")]
    folded = {name: prefer_text_id(F.col(f"{name}_str"), F.col(name)) for name in names}
    return df.withColumns(folded).drop(*(f"{name}_str" for name in names))


def cast_topic(df: DataFrame) -> DataFrame:
    """The columns of a topic post in their fixed types and order."""
    return df.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in TOPIC_POST.fields))


def to_posts(clean: DataFrame) -> DataFrame:
    """The post table: clean posts without the profile columns."""
    return clean.drop(*PROFILE_COLUMNS).select(*POST.fieldNames())


def user_mid(clean: DataFrame) -> DataFrame:
    """Profile rows: authors of shared posts, then senders; many rows per user.

    One scan: each post gives an array of one or two profiles.
    """
    shared = F.struct(
        F.col("retweet_to_uid").alias("uid"),
        F.col("retweet_to_screen_name").alias("screen_name"),
        F.col("retweet_to_description").alias("description"),
        F.col("timestamp"),
    )
    sender = F.struct(
        F.col("sender_uid").alias("uid"),
        F.col("sender_screen_name").alias("screen_name"),
        F.col("sender_description").alias("description"),
        F.col("timestamp"),
    )
    both = F.when(F.col("retweet_to_uid").isNotNull(), F.array(shared, sender)).otherwise(F.array(sender))
    return clean.select(F.inline(both))
