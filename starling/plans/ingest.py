"""Raw posts to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starling.operators import clean
from starling.operators.dedup import latest_profiles


def clean_rows(raw: DataFrame) -> DataFrame:
    """Valid posts with their ids folded, profile columns included."""
    return clean.coalesce_ids(clean.filter_valid(clean.project_posts(raw)))


def clean_posts(raw: DataFrame) -> DataFrame:
    """The post table. One narrow stage over the raw files."""
    return clean.to_posts(clean_rows(raw))


def profiles(raw: DataFrame) -> DataFrame:
    """The user table: the latest profile of each user seen as sender or as author of a shared post."""
    return latest_profiles(clean.user_mid(clean_rows(raw)))


def topic_posts(raw: DataFrame) -> DataFrame:
    """The topic post table."""
    return clean.cast_topic(clean.coalesce_ids(clean.filter_valid_topic(clean.project_topic_posts(raw))))
