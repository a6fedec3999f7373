"""Queries: projections, filters, duplicates, profiles, lookups and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from starling.functions.keys import pair_key
from starling.operators import clean, dedup, graph, lookup, quality
from starling.operators.documents import contact_docs
from starling.operators.split_points import split_points
from starling.plans import ingest
from starling.workload.registry import query
from starling.workload.views import POST_COLUMNS

_PICKED = """tid, tid_str, timestamp, content, reply_to_uid, reply_to_uid_str, sender_uid, sender_uid_str,
  sender_screen_name, sender_description, retweet_to_uid, retweet_to_uid_str, retweet_to_screen_name,
  retweet_to_description, hashtags, lang"""
_TOPIC_PICKED = """tid, tid_str, timestamp, content, sender_uid, sender_uid_str, followers_count, favorite_count,
  retweet_count, lang"""
_TOPIC = """coalesce(TRY_CAST(tid_str AS BIGINT), tid) AS tid,
  coalesce(TRY_CAST(sender_uid_str AS BIGINT), sender_uid) AS sender_uid, content, timestamp,
  CAST(followers_count AS INTEGER) AS followers_count, CAST(favorite_count AS INTEGER) AS favorite_count,
  CAST(retweet_count AS INTEGER) AS retweet_count"""
_PROFILE_ORDER = "timestamp DESC NULLS LAST, screen_name DESC NULLS LAST, description DESC NULLS LAST"

query("project_post_fields", f"SELECT {_PICKED} FROM picked")(lambda t: clean.project_posts(t.raw))
query("project_topic_fields", f"SELECT {_TOPIC_PICKED} FROM picked")(lambda t: clean.project_topic_posts(t.raw))
query("filter_valid_posts", f"SELECT {_PICKED} FROM valid")(lambda t: clean.filter_valid(clean.project_posts(t.raw)))
query("filter_valid_topic_posts", f"SELECT {_TOPIC_PICKED} FROM valid_topic WHERE lang = 'en'")(
    lambda t: clean.filter_valid_topic(clean.project_topic_posts(t.raw))
)
query("coalesce_ids", "SELECT * FROM clean")(lambda t: t.clean_rows)
query("cast_topic_types", f"SELECT {_TOPIC} FROM picked")(
    lambda t: clean.cast_topic(clean.coalesce_ids(clean.project_topic_posts(t.raw)))
)
query("q_topic_posts", f"SELECT {_TOPIC} FROM valid_topic WHERE lang = 'en'")(lambda t: ingest.topic_posts(t.raw))
query("drop_profile_columns", f"SELECT {POST_COLUMNS} FROM clean")(lambda t: clean.to_posts(t.clean_rows))
query("union_user_mid", "SELECT * FROM clean_users")(lambda t: clean.user_mid(t.clean_rows))
query(
    "q_latest_profiles",
    f"""SELECT uid, screen_name, description, timestamp FROM (SELECT *, row_number() OVER (PARTITION BY uid
  ORDER BY {_PROFILE_ORDER}) AS rn FROM clean_users) AS t WHERE rn = 1""",
)(lambda t: ingest.profiles(t.raw))

query("replies", "SELECT * EXCLUDE (retweet_to_uid) FROM posts WHERE reply_to_uid IS NOT NULL")(
    lambda t: graph.replies(t.posts)
)
query("retweets", "SELECT * EXCLUDE (reply_to_uid) FROM posts WHERE retweet_to_uid IS NOT NULL")(
    lambda t: graph.retweets(t.posts)
)

# Duplicates and profiles.
query("q_dedup_posts", "SELECT * FROM posts")(lambda t: dedup.dedup_posts(t.posts_raw))
query("semi_duplicate_rows", "SELECT * FROM posts_raw WHERE tid IN (SELECT tid FROM posts_raw GROUP BY 1 HAVING count(*) > 1)")(
    lambda t: dedup.duplicate_rows(t.posts_raw)
)
query("anti_duplicate_rows", "SELECT * FROM posts")(lambda t: dedup.dedup_by_replacement(t.posts_raw))
query("theta_keep_last", "SELECT * FROM posts WHERE tid IN (SELECT tid FROM posts_raw GROUP BY 1 HAVING count(*) > 1)")(
    lambda t: dedup.duplicate_survivors(t.posts_raw)
)
query(
    "win_row_ids",
    """SELECT tid, row_number() OVER (PARTITION BY tid) AS row_id FROM posts_raw
  WHERE tid IN (SELECT tid FROM posts_raw GROUP BY 1 HAVING count(*) > 1)""",
)(
    # Which copy gets which number is open; that each tid is numbered without gaps is not.
    lambda t: dedup.row_ids(t.posts_raw).select("tid", "row_id")
)
query("agg_duplicate_keys", "SELECT tid, sender_uid, count(*) AS count FROM posts_raw GROUP BY 1, 2 HAVING count(*) > 1")(
    lambda t: dedup.duplicates(t.posts_raw, ["tid", "sender_uid"])
)
query(
    "agg_latest_profile",
    f"""SELECT uid, screen_name, description, timestamp FROM (SELECT *, row_number() OVER (PARTITION BY uid
  ORDER BY {_PROFILE_ORDER}) AS rn FROM user_mid) AS t WHERE rn = 1""",
)(lambda t: dedup.latest_profiles(t.user_mid))
query(
    "agg_distinct_users",
    """SELECT uid, screen_name, description, timestamp FROM (SELECT *, row_number() OVER (PARTITION BY uid
  ORDER BY screen_name, description, timestamp) AS rn FROM user_mid) AS t WHERE rn = 1""",
)(lambda t: dedup.distinct_users(t.user_mid))
query(
    "win_max_partition",
    """SELECT uid, screen_name, description, timestamp FROM (SELECT *, max(timestamp) OVER (PARTITION BY uid) AS top
  FROM user_mid) AS t WHERE timestamp = top""",
)(lambda t: dedup.latest_rows(t.user_mid))

# Lookups.
_DOCS = "SELECT uid, contact_uid, part, content, hashtags FROM docs"


def _docs_of(t, uid):
    wanted = graph.replies(t.posts).where((F.col("sender_uid") == uid) | (F.col("reply_to_uid") == uid))
    return lookup.lookup_contacts(contact_docs(wanted, "reply_to_uid"), uid)


query("lookup_contacts", f"{_DOCS} WHERE type = 0 AND uid = 42")(lambda t: _docs_of(t, 42))


query("lookup_contacts_by_type", "SELECT * FROM combined WHERE uid = 7 AND type = 1")(
    lambda t: lookup.lookup_contacts_by_type(t.docs_of(7), 7, "retweet")
)
query(
    "lookup_pairs",
    "SELECT lo, hi, cnt FROM interaction WHERE concat(lo, '_', hi) IN ('5_42', '7_42', '1_7', '3_1200', '12_77', '9_9')",
)(lambda t: lookup.lookup_pairs(graph.interactions(t.posts), ["5_42", "7_42", "1_7", "3_1200", "12_77", "9_9"]))
query(
    "filter_range",
    """SELECT tid, timestamp, sender_uid FROM posts_raw WHERE timestamp BETWEEN 800000000 AND 900000000
  AND sender_uid BETWEEN 100 AND 700""",
)(
    lambda t: lookup.filter_range(t.posts_raw, 800000000, 900000000, 100, 700).select("tid", "timestamp", "sender_uid")
)
_KEYS = "(SELECT uid, contact_uid FROM directed GROUP BY 1, 2 HAVING count(DISTINCT type) = 2)"
_INTERACTING = """SELECT lo AS uid, hi AS contact_uid, cnt FROM interaction
  UNION ALL SELECT hi, lo, cnt FROM interaction WHERE lo <> hi"""


def _directed_counts(t):
    return graph.mirror(graph.interactions(t.posts), "lo", "hi", self_twice=False)


def _keys_of_both_types(t):
    rows = graph.mirror(graph.edges(t.posts), "a", "b")
    spans = rows.groupBy("uid", "contact_uid").agg(F.min("type").alias("x"), F.max("type").alias("y"))
    return spans.where("x <> y").select("uid", "contact_uid")


query("filter_key_set", f"SELECT * FROM ({_INTERACTING}) AS c WHERE (uid, contact_uid) IN {_KEYS}")(
    lambda t: lookup.filter_keys(_directed_counts(t), _keys_of_both_types(t))
)
query(
    "patch_rows",
    f"""SELECT uid, contact_uid, CASE WHEN (uid, contact_uid) IN {_KEYS} THEN concat(content, ' ') ELSE content END
  AS latest_post FROM (SELECT lo AS uid, hi AS contact_uid, content FROM latest
  UNION ALL SELECT hi, lo, content FROM latest WHERE lo <> hi) AS c""",
)(
    lambda t: lookup.patch(
        graph.mirror(
            graph.latest_contact(t.posts).select("lo", "hi", F.col("content").alias("latest_post")), "lo", "hi", self_twice=False
        ),
        _keys_of_both_types(t).unionByName(_keys_of_both_types(t)),
        "latest_post",
        F.concat("latest_post", F.lit(" ")),
    )
)


def _sql_over_views(t):
    lookup.register(t.spark, {"starling_user_mid": t.user_mid})
    return t.spark.sql(
        "SELECT screen_name, count(*) AS n, max(timestamp) AS newest FROM starling_user_mid GROUP BY screen_name"
    )


query("sql_over_views", "SELECT screen_name, count(*) AS n, max(timestamp) AS newest FROM user_mid GROUP BY 1")(_sql_over_views)
query(
    "check_numeric_time",
    """SELECT uid, stamp FROM (SELECT uid, CASE WHEN screen_name LIKE '1%' THEN concat('t', timestamp)
  ELSE CAST(timestamp AS VARCHAR) END AS stamp FROM user_mid) AS t WHERE TRY_CAST(stamp AS BIGINT) IS NULL""",
)(
    lambda t: quality.check_numeric(
        t.user_mid.select(
            "uid",
            F.when(F.col("screen_name").startswith("1"), F.concat(F.lit("t"), F.col("timestamp").cast("string")))
            .otherwise(F.col("timestamp").cast("string"))
            .alias("stamp"),
        ),
        "stamp",
    )
)
query(
    "agg_row_counts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS rows FROM {view}"
        for name, view in (("posts", "posts_raw"), ("users", "users"), ("profiles", "user_mid"), ("topic_posts", "topic_posts"))
    ),
)(
    lambda t: quality.row_counts(
        {"posts": t.posts_raw, "users": t.users, "profiles": t.user_mid, "topic_posts": t.topic_posts}
    )
)


# Split points: by user number, and by pair key in text order.
def _points(key: str, view: str, parts: int) -> str:
    ranks = f"""SELECT {key} AS split_key, row_number() OVER (ORDER BY {key}) AS rank, count(*) OVER () AS n FROM {view}"""
    return f"""SELECT rank, split_key FROM ({ranks}) AS r WHERE rank IN
  (SELECT CAST(floor(i * r.n / {float(parts)} + 0.5) AS BIGINT) FROM generate_series(1, {parts - 1}) AS g(i))"""


query("win_split_points", _points("uid", "directed", 10))(
    lambda t: split_points(graph.mirror(graph.edges(t.posts), "a", "b"), "uid", 10)
)
query("sort_keys", _points("concat(lo, '_', hi)", "interaction", 7))(
    lambda t: split_points(
        graph.interactions(t.posts).select(pair_key(F.col("lo"), F.col("hi")).alias("pair")), "pair", 7
    )
)
