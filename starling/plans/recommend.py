"""Contacts ranked for a table of requests (request_id, uid, type, phrase, hashtag)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions import scores
from starling.functions.keys import pair_high, pair_low
from starling.functions.text import count_matches, format_contact
from starling.operators.dedup import first_rows
from starling.operators.graph import edges, mirror, with_profile
from starling.operators.hashtags import shared_tags, tag_counts
from starling.operators.lookup import type_of
from starling.operators.positions import places_in_order
from starling.session import materialize

CONTACT = ("request_id", "uid", "contact_uid", "phrase_matches", "tag_matches", "interaction", "latest_post")


def request_contacts(requests: DataFrame, posts: DataFrame) -> DataFrame:
    """Per request and contact: matches in posts of the asked type, interactions, and the latest contact post.

    Requests are joined before anything else, so only contacts of the asked users are aggregated. Matches are counted
    in each post and summed; no document is built. Interactions and the latest post cover both types.
    """
    asked = requests.select(
        "request_id", "uid", type_of(F.col("type")).alias("asked"), "phrase", F.lower("hashtag").alias("hashtag_term")
    )
    # Ids are mirrored and cut to the asked users; only then texts come, once for each post that is left. Which side is
    # sent to all tasks is left to Spark, which knows the sizes.
    linked = mirror(edges(posts, "tid"), "a", "b").join(asked.select("uid").distinct(), "uid", "left_semi")
    hits = linked.join(posts.select("tid", "timestamp", "content", "hashtags"), "tid").join(asked, "uid")

    in_type = F.col("asked").isNull() | (F.col("asked") == F.col("type"))
    phrases = count_matches(F.col("content"), F.col("phrase"))
    tags = count_matches(F.lower("hashtags"), F.col("hashtag_term"))
    # A post to oneself comes twice among the documents but is one interaction.
    weight = F.col("weight") / F.when(F.col("uid") == F.col("contact_uid"), 2).otherwise(1)
    facts = hits.groupBy("request_id", "uid", "contact_uid").agg(
        F.max(in_type).alias("in_type"),
        F.sum(F.when(in_type, phrases).otherwise(0)).alias("phrase_matches"),
        F.sum(F.when(in_type, tags).otherwise(0)).alias("tag_matches"),
        F.sum(weight).cast("bigint").alias("interaction"),
    )
    newest = [F.desc("timestamp"), F.desc("tid"), F.desc("content")]
    posts_of = hits.select("request_id", "contact_uid", "timestamp", "tid", "content")
    latest = first_rows(posts_of, ["request_id", "contact_uid"], newest)
    latest = latest.select("request_id", "contact_uid", F.col("content").alias("latest_post"))
    # One uid for each request, so request and contact are the key.
    return facts.where("in_type").drop("in_type").join(latest, ["request_id", "contact_uid"]).select(*CONTACT)


def _overlap(contacts: DataFrame, posts: DataFrame, popular: DataFrame) -> DataFrame:
    """Shared-tag totals of the requested pairs; tags are counted for users in those pairs only, and stored."""
    low, high = pair_low(F.col("uid"), F.col("contact_uid")), pair_high(F.col("uid"), F.col("contact_uid"))
    pairs = contacts.select(low.alias("lo"), high.alias("hi")).distinct()
    involved = pairs.select(F.explode(F.array("lo", "hi")).alias("sender_uid")).distinct()
    tagged = posts.select("sender_uid", "hashtags").join(involved, "sender_uid", "left_semi")
    return shared_tags(pairs, materialize(tag_counts(tagged, popular), "tags")).withColumnRenamed("cnt", "overlap")


def score_contacts(contacts: DataFrame) -> DataFrame:
    """Add the score of rows with phrase_matches, tag_matches, overlap and interaction."""
    score = scores.contact_score(
        scores.keyword_score(F.col("phrase_matches"), F.col("tag_matches")),
        scores.hashtag_score(F.col("overlap")),
        scores.interaction_score(F.col("interaction")),
    )
    return contacts.withColumn("score", score)


def sort_contacts(scored: DataFrame) -> DataFrame:
    """Best first, equal scores by higher contact. A sort by ranges, so a request with many contacts is spread."""
    return scored.orderBy("request_id", F.desc("score"), F.desc("contact_uid"))


def ranked(ordered: DataFrame) -> DataFrame:
    """Add the rank within the request, from 1, of rows that come in the order of sort_contacts."""
    return places_in_order(ordered, ["request_id"]).withColumn("rank", F.col("_place") + 1).drop("_place")


def recommend(requests: DataFrame, posts: DataFrame, users: DataFrame, popular: DataFrame) -> DataFrame:
    """Scored contacts of each request with profile, latest post and the response line. Posts unique by tid.

    The contacts are stored: later steps read them again, and their size decides which joins broadcast.
    """
    contacts = materialize(request_contacts(requests, posts), "contacts")
    overlap = _overlap(contacts, posts, popular)
    keyed = contacts.withColumns(
        {"lo": pair_low(F.col("uid"), F.col("contact_uid")), "hi": pair_high(F.col("uid"), F.col("contact_uid"))}
    )
    joined = keyed.join(overlap, ["lo", "hi"], "left").withColumn("overlap", F.coalesce("overlap", F.lit(0)))
    scored = with_profile(score_contacts(joined), users)
    line = format_contact(*(F.col(c) for c in ("contact_uid", "screen_name", "description", "latest_post")))
    return scored.select(
        "request_id",
        "uid",
        "contact_uid",
        (F.col("phrase_matches") + F.col("tag_matches")).alias("matches"),
        "interaction",
        "overlap",
        "score",
        line.alias("line"),
    )
