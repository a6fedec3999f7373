"""Queries: scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from starling.functions import keys, scores, text
from starling.operators import graph
from starling.plans import recommend as rec
from starling.workload.registry import query
from starling.workload.views import matches, no_urls

C = F.col

query(
    "fn_parse_time",
    "SELECT tid, tid_str, timestamp FROM picked",
)(lambda t: t.raw.select(C("id").alias("tid"), C("id_str").alias("tid_str"), keys.parse_time(C("created_at")).alias("timestamp")))
query("fn_join_hashtags", "SELECT tid, tid_str, hashtags FROM picked")(
    lambda t: t.raw.select(
        C("id").alias("tid"), C("id_str").alias("tid_str"), text.join_tags(C("entities.hashtags.text")).alias("hashtags")
    )
)
query("fn_length", "SELECT tid, length(hashtags) AS n FROM posts")(
    lambda t: t.posts.select("tid", F.length("hashtags").cast("bigint").alias("n"))
)
query("fn_byte_length", "SELECT tid, octet_length(encode(content)) AS n FROM topic_posts")(
    lambda t: t.topic_posts.select("tid", text.byte_length(C("content")).cast("bigint").alias("n"))
)
query("fn_pair_key", "SELECT tid, concat(least(a, b), '_', greatest(a, b)) AS pair FROM edges")(
    lambda t: graph.edges(t.posts, "tid").select("tid", keys.pair_key(C("a"), C("b")).alias("pair"))
)


def _split_pairs(t):
    named = graph.interactions(t.posts).select(keys.pair_key(C("lo"), C("hi")).alias("pair"))
    low, high = keys.split_pair(C("pair"))
    return named.select("pair", low.alias("lo"), high.alias("hi"))


query("fn_split_pair", "SELECT concat(lo, '_', hi) AS pair, lo, hi FROM interaction")(_split_pairs)
query(
    "fn_null_default",
    """SELECT tid, coalesce(favorite_count, 0) AS favorite_count, coalesce(retweet_count, 0) AS retweet_count
  FROM topic_posts""",
)(
    lambda t: t.topic_posts.select(
        "tid", *(keys.or_default(C(c), 0).alias(c) for c in ("favorite_count", "retweet_count"))
    )
)
query("fn_lower", "SELECT tid, lower(content) AS text FROM topic_posts")(
    lambda t: t.topic_posts.select("tid", F.lower("content").alias("text"))
)
query(
    "fn_split_tags",
    """SELECT tid, len(string_split(hashtags, ',')) AS n, array_to_string(string_split(hashtags, ','), '|') AS tags
  FROM posts""",
)(
    # Commas at the end add no tags.
    lambda t: t.posts.select("tid", text.split_tags(F.concat("hashtags", F.lit(",,"))).alias("list")).select(
        "tid", F.size("list").cast("bigint").alias("n"), F.array_join("list", "|").alias("tags")
    )
)
query("fn_prefix_until", "SELECT tid, split_part(content, ' ', 1) AS head FROM topic_posts")(
    lambda t: t.topic_posts.select("tid", text.prefix_until(C("content"), " ").alias("head"))
)
query("fn_append", "SELECT tid, concat(content, ' ') AS content FROM posts")(
    lambda t: t.posts.select("tid", text.append(C("content"), " ").alias("content"))
)
query("fn_strip_urls", f"SELECT tid, {no_urls('content')} AS text FROM topic_posts")(
    lambda t: t.topic_posts.select("tid", text.strip_urls(C("content")).alias("text"))
)
query(
    "fn_count_matches",
    f"SELECT tid, CAST({matches('content', 'lang')} AS BIGINT) AS matches FROM topic_posts",
)(lambda t: t.topic_posts.select("tid", text.count_matches(C("content"), C("lang")).alias("matches")))
query(
    "fn_keyword_score",
    "SELECT request_id, contact_uid, round(1 + ln(phrase_matches + tag_matches + 1), 6) AS score FROM contacts",
)(
    lambda t: rec.request_contacts(t.contact_requests, t.posts).select(
        "request_id",
        "contact_uid",
        F.round(scores.keyword_score(C("phrase_matches"), C("tag_matches")), 6).alias("score"),
    )
)


def _overlap_pairs(t):
    from starling.operators.hashtags import contact_overlap
    from starling.workload.graph import pairs_and_counts

    return contact_overlap(*pairs_and_counts(t))


query(
    "fn_hashtag_score",
    "SELECT lo, hi, round(CASE WHEN overlap > 10 THEN 1 + ln(1 + overlap - 10) ELSE 1 END, 6) AS score FROM overlap",
)(lambda t: _overlap_pairs(t).select("lo", "hi", F.round(scores.hashtag_score(C("overlap")), 6).alias("score")))
query("fn_interaction_score", "SELECT lo, hi, round(1 + ln(1 + cnt), 6) AS score FROM interaction")(
    lambda t: graph.interactions(t.posts).select("lo", "hi", F.round(scores.interaction_score(C("cnt")), 6).alias("score"))
)
query("fn_contact_score", "SELECT request_id, contact_uid, round(score, 6) AS score FROM scored")(
    lambda t: rec.recommend(t.contact_requests, t.stored_posts, t.users, t.popular).select(
        "request_id", "contact_uid", F.round("score", 6).alias("score")
    )
)
query(
    "fn_rot13",
    """SELECT tid, translate(lower(content), 'abcdefghijklmnopqrstuvwxyz', 'nopqrstuvwxyzabcdefghijklm') AS text
  FROM topic_posts""",
)(lambda t: t.topic_posts.select("tid", text.rot13(F.lower("content")).alias("text")))
query(
    "fn_format_contact",
    """SELECT i.lo, i.hi, concat(i.hi, chr(9), coalesce(u.screen_name, ''), chr(9), coalesce(u.description, ''), chr(9), l.content)
  AS line FROM interaction i JOIN latest l ON l.lo = i.lo AND l.hi = i.hi LEFT JOIN users u ON u.uid = i.hi""",
)(
    lambda t: graph.latest_contact(t.posts)
    .join(t.users.withColumnRenamed("uid", "hi"), "hi", "left")
    .select(
        "lo", "hi", text.format_contact(C("hi"), C("screen_name"), C("description"), C("content")).alias("line")
    )
)
