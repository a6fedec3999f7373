"""Recommendations and lookups from stored tables that are laid out by user.

Three tables are written once, each cut into ranges of users and sorted, so that the files and row groups of other users
are skipped by their bounds:

- matches: the contact posts of each user, in both directions, with what matches are counted in;
- facts: one row for each user and contact, with interactions, shared tags, latest post and profile;
- docs: the combined table, one row for each user, contact, type and page.

A table of requests is turned into at most RANGES ranges of users, which reach the scans as literals; a join on the user
does the rest. Numbers are counted first, and texts of facts join what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.functions.text import count_matches, format_contact
from starling.operators.graph import edges, mirror, with_profile
from starling.operators.lookup import type_of
from starling.plans.combined import combined, contact_facts
from starling.plans.recommend import score_contacts
from starling.session import materialize
from starling.sinks.files import write_serving

# Ranges of users that are pushed to the scans.
RANGES = 100
LAYOUTS = {
    "matches": ["uid", "contact_uid", "type", "timestamp", "tid"],
    "facts": ["uid", "contact_uid"],
    "docs": ["uid", "contact_uid", "type", "part"],
}


def matches_of(posts: DataFrame) -> DataFrame:
    """Contact posts of each user with each contact; a post to oneself comes twice."""
    return mirror(edges(posts, "timestamp", "tid", "content", "hashtags").drop("weight"), "a", "b")


def facts_of(posts: DataFrame, users: DataFrame, popular: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """Interactions, shared tags, latest post and profile of each user and contact."""
    return with_profile(mirror(contact_facts(posts, popular, every), "lo", "hi", self_twice=False), users)


def posts_between(posts: DataFrame, uids: DataFrame) -> DataFrame:
    """The contact posts of the listed users, in both directions. Ids are cut to them first; texts come for what is left."""
    wanted = mirror(edges(posts, "tid"), "a", "b").join(uids, "uid", "left_semi").select(F.col("tid").alias("_tid")).distinct()
    return posts.join(wanted, F.col("tid").eqNullSafe(F.col("_tid")), "left_semi")


def write(
    posts: DataFrame,
    users: DataFrame,
    popular: DataFrame,
    path: str,
    docs: bool = True,
    uids: DataFrame | None = None,
) -> None:
    """Write the tables below a folder. Posts must be unique by tid and stored: several tables are made from them.

    Tables for some users (`uids`, column uid) hold the same rows as those for all, of these users only: neither the other
    pairs nor their shared tags are made.
    """
    between, every, own = posts, None, lambda df: df
    if uids is not None:
        uids = materialize(uids.select("uid").where("uid IS NOT NULL").distinct(), "uids")
        between, every, own = materialize(posts_between(posts, uids), "between"), posts, lambda df: df.join(uids, "uid", "left_semi")
    made = {
        "matches": lambda: matches_of(between),
        "facts": lambda: facts_of(between, users, popular, every),
        "docs": lambda: combined(between, users, popular, every=every),
    }
    for name in LAYOUTS if docs else ("matches", "facts"):
        table = made[name]()
        write_serving(own(table).select(*table.columns), f"{path}/{name}", LAYOUTS[name])


def user_ranges(requests: DataFrame, most: int = RANGES) -> Column:
    """A condition on uid that all requested users meet: at most `most` ranges, as literals."""
    low, high = requests.agg(F.min("uid"), F.max("uid")).first()
    if low is None:
        return F.lit(False)
    width = (high - low) // most + 1
    parts = requests.groupBy(F.floor((F.col("uid") - low) / width).alias("part")).agg(F.min("uid").alias("low"), F.max("uid").alias("high"))
    within = F.lit(False)
    for row in parts.where("low IS NOT NULL").orderBy("low").collect():
        within = within | F.col("uid").between(row.low, row.high)
    return within


def contacts(requests: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Per request and contact: matches in posts of the asked type, and the facts of the pair."""
    within = user_ranges(requests)
    asked = requests.select(
        "request_id", "uid", type_of(F.col("type")).alias("asked"), "phrase", F.lower("hashtag").alias("hashtag_term")
    )
    posts = spark.read.parquet(f"{path}/matches").where(within)
    phrases = count_matches(F.col("content"), F.col("phrase"))
    tags = count_matches(F.lower("hashtags"), F.col("hashtag_term"))
    in_type = posts.join(asked, "uid").where("asked IS NULL OR asked = type")
    counted = in_type.groupBy("request_id", "uid", "contact_uid").agg(
        F.sum(phrases).alias("phrase_matches"), F.sum(tags).alias("tag_matches")
    )
    facts = spark.read.parquet(f"{path}/facts").where(within).withColumnRenamed("hashtag_cnt", "overlap")
    return counted.join(facts, ["uid", "contact_uid"])


def recommend(requests: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """The rows of plans.recommend.recommend, from the stored tables."""
    scored = score_contacts(contacts(requests, spark, path))
    line = format_contact(*(F.col(c) for c in ("contact_uid", "screen_name", "description", "latest_post")))
    matches = (F.col("phrase_matches") + F.col("tag_matches")).alias("matches")
    return scored.select("request_id", "uid", "contact_uid", matches, "interaction", "overlap", "score", line.alias("line"))
