"""Ids, pair keys and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the time format after the weekday, as in "Apr 04 05:40:22 +0000 2014".
POST_TIME_FORMAT = "MMM dd HH:mm:ss Z yyyy"


def parse_time(created_at: Column) -> Column:
    """Epoch seconds of a post time. The weekday is cut off and not checked; other text gives null."""
    return F.unix_seconds(F.try_to_timestamp(F.substring(created_at, 5, 30), F.lit(POST_TIME_FORMAT)))


def prefer_text_id(text_id: Column, number_id: Column) -> Column:
    """The text form of an id where it holds a number, else the numeric form."""
    return F.coalesce(text_id.try_cast("bigint"), number_id)


def pair_low(a: Column, b: Column) -> Column:
    return F.least(a, b)


def pair_high(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def pair_key(a: Column, b: Column) -> Column:
    """Text key low_high. Inside plans the two numbers are kept apart; this is for files and lookups."""
    return F.concat_ws("_", F.least(a, b), F.greatest(a, b))


def split_pair(pair: Column) -> tuple[Column, Column]:
    """Text before the first and after the last underscore, as numbers; null where it is none."""
    low = F.substring_index(pair, "_", 1).try_cast("bigint")
    high = F.substring_index(pair, "_", -1).try_cast("bigint")
    return low, high


def or_default(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))
