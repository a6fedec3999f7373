"""One wide row per user, contact and type, for lookups by user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.operators.documents import PAGE_ROWS, typed_pair_docs
from starling.operators.graph import interactions, latest_contact, latest_interaction, mirror, with_profile
from starling.operators.hashtags import contact_overlap, tag_counts
from starling.session import materialize

COLUMNS = (
    "uid",
    "contact_uid",
    "type",
    "part",
    "interaction",
    "latest_post",
    "hashtag_cnt",
    "hashtags",
    "content",
    "screen_name",
    "description",
)


def pair_facts(posts: DataFrame) -> DataFrame:
    """Interaction count and latest contact post of each unordered pair.

    The counts are sums of numbers that combine in the task. The latest post is a first row, which each task picks for
    itself before the shuffle, so a hot pair is one text per task; no text goes through an aggregate.
    """
    return latest_interaction(latest_contact(posts), interactions(posts))


def contact_facts(posts: DataFrame, popular: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """lo, hi, interaction, latest_post and hashtag_cnt of each unordered pair; facts and tag counts are stored, as both are read again.

    Where `posts` are those of some pairs only, `every` holds the posts from which the tags of their users are counted.
    """
    facts = materialize(pair_facts(posts), "facts")
    if every is not None:
        involved = facts.select(F.explode(F.array("lo", "hi")).alias("sender_uid")).distinct()
        posts = every.select("sender_uid", "hashtags").join(involved, "sender_uid", "left_semi")
    counts = materialize(tag_counts(posts, popular), "tags")
    overlap = contact_overlap(facts, counts).withColumnRenamed("overlap", "hashtag_cnt")
    return facts.join(overlap, ["lo", "hi"])


def combined(
    posts: DataFrame, users: DataFrame, popular: DataFrame, page_rows: int = PAGE_ROWS, every: DataFrame | None = None
) -> DataFrame:
    """Documents, shared tags, interactions, latest post and profile of each contact.

    Everything but the profile is the same for both directions of a pair, so it is built once per unordered pair and
    mirrored last; a pair of a user with itself gives one row. Posts must be unique by tid and stored: they are read
    once per branch, each with its own columns. For `every` see contact_facts.
    """
    pairs = typed_pair_docs(posts, page_rows).join(contact_facts(posts, popular, every), ["lo", "hi"])
    return with_profile(mirror(pairs, "lo", "hi", self_twice=False), users).select(*COLUMNS)
