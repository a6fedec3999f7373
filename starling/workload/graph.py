"""Queries: contact graph, documents, hashtags, the combined table and recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from starling.operators import documents, graph, hashtags, similar_users
from starling.operators.lookup import TYPE_WORDS
from starling.plans import recommend as rec
from starling.plans import serving
from starling.plans.combined import combined
from starling.session import materialize
from starling.workload.registry import query
from starling.workload.views import paged

_INTERACTION = "SELECT lo, hi, cnt FROM interaction"
_PAIR_COUNT = "SELECT least(a, b) AS lo, greatest(a, b) AS hi, count(*) AS cnt FROM edges WHERE type = {} GROUP BY 1, 2"

query("agg_reply_pairs", _PAIR_COUNT.format(0))(lambda t: graph.pair_counts(graph.replies(t.posts), "reply_to_uid"))
query("agg_retweet_pairs", _PAIR_COUNT.format(1))(lambda t: graph.pair_counts(graph.retweets(t.posts), "retweet_to_uid"))
query("agg_interaction", _INTERACTION)(lambda t: graph.interactions(t.posts))
query("q_interactions", _INTERACTION)(lambda t: graph.interactions(t.posts))
_BOTH_COUNTS = """SELECT least(a, b) AS lo, greatest(a, b) AS hi, count(*) FILTER (type = 0) AS reply_count,
  count(*) FILTER (type = 1) AS retweet_count, CAST(sum(weight) AS BIGINT) AS cnt FROM edges GROUP BY 1, 2"""
query("join_full_interaction", _BOTH_COUNTS)(lambda t: graph.interactions_by_join(t.posts))
query("union_distinct_outer", f"SELECT lo, hi FROM ({_BOTH_COUNTS}) AS b WHERE reply_count = 0 OR retweet_count = 0")(
    lambda t: graph.interactions_by_join(t.posts).where("reply_count = 0 OR retweet_count = 0").select("lo", "hi")
)

_MIRRORED = "SELECT lo AS uid, hi AS contact_uid, cnt FROM interaction UNION ALL SELECT hi, lo, cnt FROM interaction"
query("union_mirror_edges", _MIRRORED)(lambda t: graph.mirror(graph.interactions(t.posts), "lo", "hi"))
query(
    "union_contact_posts",
    "SELECT least(a, b) AS lo, greatest(a, b) AS hi, CAST(type AS INTEGER) AS type, tid, content, timestamp FROM edges",
)(lambda t: graph.contact_posts(t.posts))
for _name in ("win_latest_contact", "q_latest_contact"):
    query(_name, "SELECT tid, lo, hi, content, timestamp FROM latest")(lambda t: graph.latest_contact(t.posts))
query(
    "join_latest_interaction",
    """SELECT l.lo, l.hi, l.content AS latest_post, i.cnt AS interaction FROM latest l
  JOIN interaction i ON i.lo = l.lo AND i.hi = l.hi""",
)(lambda t: graph.latest_interaction(graph.latest_contact(t.posts), graph.interactions(t.posts)))
query(
    "join_contact_profile",
    f"""SELECT m.*, coalesce(u.screen_name, '') AS screen_name, coalesce(u.description, '') AS description
  FROM ({_MIRRORED}) AS m LEFT JOIN users u ON u.uid = m.contact_uid""",
)(lambda t: graph.with_profile(graph.mirror(graph.interactions(t.posts), "lo", "hi"), t.users))

# Documents.
_DOCS = "SELECT uid, contact_uid, part, content, hashtags FROM docs WHERE type = {}"
_PAIR_DOCS = f"""SELECT lo, hi, part, string_agg(content, ',' ORDER BY timestamp, tid, content) AS content,
  string_agg(hashtags, ',' ORDER BY timestamp, tid, content, hashtags) AS hashtags
  FROM ({paged("(SELECT *, least(a, b) AS lo, greatest(a, b) AS hi FROM edges WHERE type = {})", "lo, hi")}) AS p GROUP BY 1, 2, 3"""
_SMALL_PAGES = f"""SELECT uid, contact_uid, part, string_agg(content, ',' ORDER BY timestamp, tid, content) AS content,
  string_agg(hashtags, ',' ORDER BY timestamp, tid, content, hashtags) AS hashtags
  FROM ({paged("(SELECT * FROM directed WHERE type = 1)", "uid, contact_uid", 3)}) AS p GROUP BY 1, 2, 3"""
query("agg_contact_docs_reply", _DOCS.format(0))(lambda t: documents.reply_docs(t.stored_posts))
query("agg_contact_docs_retweet", _DOCS.format(1))(lambda t: documents.retweet_docs(t.stored_posts))
# Pages of three rows, so that most keys have several.
query("agg_contact_docs_pages", _SMALL_PAGES)(
    lambda t: documents.contact_docs(graph.retweets(t.stored_posts), "retweet_to_uid", page_rows=3)
)
query("agg_keyword_pair_reply", _PAIR_DOCS.format(0))(lambda t: documents.pair_docs(t.stored_posts, graph.REPLY))
query("agg_keyword_pair_retweet", _PAIR_DOCS.format(1))(lambda t: documents.pair_docs(t.stored_posts, graph.RETWEET))

# Hashtags.
query("anti_popular_tags", "SELECT uid, tag, timestamp, tid FROM kept_tags")(
    lambda t: hashtags.drop_terms(hashtags.tags(t.posts, "timestamp", "tid"), t.popular).drop("pos")
)
query("agg_user_tag_counts", "SELECT uid, tag, cnt FROM tag_counts")(lambda t: hashtags.tag_counts(t.posts, t.popular))
query(
    "agg_user_hashtags",
    f"""SELECT uid AS sender_uid, part, string_agg(tag, ',' ORDER BY timestamp, tid, pos) AS hashtags
  FROM ({paged("kept_tags", "uid", order="timestamp, tid, pos")}) AS t GROUP BY 1, 2""",
)(lambda t: hashtags.user_tags(t.stored_posts, t.popular))


def pairs_and_counts(t):
    """Pairs in contact and the uses of tags, both stored."""
    posts = materialize(t.posts.select("tid", "sender_uid", "reply_to_uid", "retweet_to_uid", "hashtags"), "posts")
    pairs = materialize(graph.interactions(posts).select("lo", "hi"), "pairs")
    return pairs, materialize(hashtags.tag_counts(posts, t.popular), "tags")


query("shared_hashtag_pairs", "SELECT lo, hi, overlap AS cnt FROM overlap WHERE lo <> hi AND overlap > 0")(
    lambda t: hashtags.shared_hashtag_pairs(*pairs_and_counts(t))
)
# Of all users, not only of those in contact.
_LEAST_SHARED = 30
query(
    "shared_hashtag_pairs_above",
    f"""SELECT x.uid AS lo, y.uid AS hi, CAST(sum(x.cnt + y.cnt) AS BIGINT) AS cnt FROM tag_counts x
  JOIN tag_counts y ON y.tag = x.tag AND x.uid < y.uid GROUP BY 1, 2 HAVING sum(x.cnt + y.cnt) >= {_LEAST_SHARED}""",
)(lambda t: similar_users.pairs_above(pairs_and_counts(t)[1], _LEAST_SHARED))
query("contact_hashtag_overlap", "SELECT lo, hi, overlap FROM overlap")(
    lambda t: hashtags.contact_overlap(*pairs_and_counts(t))
)

# The combined table. The posts are stored once and read by every branch.
_COMBINED = "SELECT * FROM combined"


def _combined(t):
    return combined(t.stored_posts, t.users, t.popular)


for _name in ("combine_contacts", "q_combined"):
    query(_name, _COMBINED)(_combined)
query("join_reply_doc", f"{_COMBINED} WHERE type = 0")(lambda t: _combined(t).where(F.col("type") == graph.REPLY))
query("join_retweet_doc", f"{_COMBINED} WHERE type = 1")(lambda t: _combined(t).where(F.col("type") == graph.RETWEET))

# Recommendations.
_RECOMMEND = """SELECT s.request_id, s.uid, s.contact_uid, CAST(s.phrase_matches + s.tag_matches AS BIGINT) AS matches,
  s.interaction, s.overlap, round(s.score, 6) AS score,
  concat(s.contact_uid, chr(9), coalesce(u.screen_name, ''), chr(9), coalesce(u.description, ''), chr(9), s.latest_post)
  AS line FROM scored s LEFT JOIN users u ON u.uid = s.contact_uid"""


def _recommend(t):
    found = rec.recommend(t.contact_requests, t.stored_posts, t.users, t.popular)
    return found.withColumn("score", F.round("score", 6))


def _recommend_stored(t):
    found = serving.recommend(t.contact_requests, t.spark, t.serving)
    return found.withColumn("score", F.round("score", 6))


query("q_recommend", _RECOMMEND)(_recommend_stored)
# The same without stored tables, for requests that are asked once.
query("q_recommend_at_once", _RECOMMEND)(_recommend)
# The rank says in which order the rows come.
query(
    "sort_contacts",
    f"""SELECT *, CAST(row_number() OVER (PARTITION BY request_id ORDER BY score DESC, contact_uid DESC) AS BIGINT) AS rank
  FROM ({_RECOMMEND}) AS r""",
)(lambda t: rec.ranked(rec.sort_contacts(_recommend_stored(t))))
query(
    "join_requests_contacts",
    """SELECT c.request_id, c.uid, c.contact_uid, CAST(c.phrase_matches AS BIGINT) AS phrase_matches,
  CAST(c.tag_matches AS BIGINT) AS tag_matches, s.interaction, s.latest_post FROM contacts c JOIN scored s
  ON s.request_id = c.request_id AND s.contact_uid = c.contact_uid""",
)(lambda t: serving.contacts(t.contact_requests, t.spark, t.serving).select(*rec.CONTACT))
query(
    "agg_merge_types",
    """SELECT request_id, contact_uid, CAST(phrase_matches + tag_matches AS BIGINT) AS matches, interaction FROM scored
  WHERE request_id IN (SELECT request_id FROM contact_requests WHERE type NOT IN ('reply', 'retweet'))""",
)(
    lambda t: serving.contacts(t.contact_requests.where(~F.col("type").isin(*TYPE_WORDS)), t.spark, t.serving).select(
        "request_id", "contact_uid", (F.col("phrase_matches") + F.col("tag_matches")).alias("matches"), "interaction"
    )
)
