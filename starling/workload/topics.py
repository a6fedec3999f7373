"""Queries: words, scores, ranges, topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from starling.functions import scores, text
from starling.operators import hashtags, ranges, summaries, terms
from starling.operators import topics as ops
from starling.plans import topics as plan
from starling.session import materialize
from starling.workload.registry import query
from starling.workload.views import STOP, TOKEN, censored, words

query("agg_term_counts", "SELECT tid, word, cnt, CAST(doc_len AS BIGINT) AS doc_len FROM terms")(
    lambda t: ops.term_counts(t.topic_posts)
)
query("agg_doc_length", "SELECT tid, len(ws) AS doc_len FROM word_lists")(
    lambda t: t.topic_posts.select("tid", F.size(ops.post_words(F.col("content"))).cast("bigint").alias("doc_len"))
)
query("agg_doc_freq", "SELECT word, df FROM freqs")(lambda t: ops.doc_freq(t.topic_posts))
query("agg_corpus_size", "SELECT request_id, count(*) AS n FROM found GROUP BY 1")(
    lambda t: ops.corpus_size(ranges.range_join(t.topic_requests, t.topic_posts.drop("content")))
)


def _asked(t, stored):
    return summaries.asked(t.topic_requests, stored)


query("agg_corpus_size_stored", "SELECT request_id, count(*) AS n FROM found GROUP BY 1")(
    lambda t: summaries.request_sizes(*_asked(t, t.topic_sizes), t.topic_sizes)
)
query(
    "agg_request_word_sums",
    f"""SELECT f.request_id, t.word, count(*) AS df, round(sum(CAST(t.cnt AS DOUBLE) / t.doc_len * ln(f.impact + 1)), 6) AS weight
  FROM found f JOIN terms t ON t.tid = f.tid WHERE NOT list_contains({STOP}, t.word) GROUP BY 1, 2""",
)(
    lambda t: summaries.request_words(*_asked(t, t.topic_sums), t.topic_sums, t.stop).withColumn("weight", F.round("weight", 6))
)
query("agg_effective_words", "SELECT tid, effective FROM impacts")(
    lambda t: t.topic_posts.select("tid", text.effective_words(F.col("content"), t.stop).cast("bigint").alias("effective"))
)
query(
    "agg_topic_score",
    f"""SELECT word, df, n, round(weight * ln(CAST(n AS DOUBLE) / df), 6) AS score FROM (
  SELECT t.word, count(*) AS df, (SELECT count(*) FROM topic_posts) AS n,
  sum(CAST(t.cnt AS DOUBLE) / t.doc_len * ln(i.impact + 1)) AS weight FROM terms t JOIN impacts i ON i.tid = t.tid
  WHERE NOT list_contains({STOP}, t.word) GROUP BY 1) AS x""",
)(lambda t: ops.topic_scores(t.topic_posts, t.stop).withColumn("score", F.round("score", 6)))
query("anti_stopwords", f"SELECT word, df FROM freqs WHERE NOT list_contains({STOP}, word)")(
    lambda t: hashtags.drop_terms(ops.doc_freq(t.topic_posts), t.terms(tuple(t.stop)), "word")
)
_TERMS = ["widget", "license", "ring", "ouen"]
query(
    "semi_posts_with_topics",
    f"""SELECT tid, sender_uid FROM topic_posts WHERE len(list_intersect(list_transform(
  regexp_extract_all(content, '{TOKEN}'), lambda t: lower(t)), ['widget', 'license', 'ring', 'ouen'])) > 0""",
)(lambda t: ops.posts_with_terms(t.topic_posts, _TERMS).select("tid", "sender_uid"))
query("range_join_requests_posts", "SELECT request_id, tid FROM found")(
    lambda t: ranges.range_join(t.topic_requests, t.topic_posts).select("request_id", "tid")
)
query("fn_impact", "SELECT tid, impact FROM impacts")(
    lambda t: ops.with_impact(t.topic_posts, t.stop).select("tid", "impact")
)
query(
    "fn_tf_idf",
    """SELECT t.tid, t.word, round(CAST(t.cnt AS DOUBLE) / t.doc_len * ln((SELECT count(*) FROM topic_posts) / CAST(f.df AS DOUBLE)), 6)
  AS tf_idf FROM terms t JOIN freqs f ON f.word = t.word""",
)(
    lambda t: ops.term_counts(t.topic_posts)
    # Stored, so that its size says whether each task gets it whole.
    .join(materialize(ops.doc_freq(t.topic_posts), "doc-freq"), "word")
    .withColumn("n", t.topic_posts.select(F.count("*")).scalar())
    .select(
        "tid",
        "word",
        F.round(scores.tf_idf(*(F.col(c) for c in ("cnt", "doc_len", "n", "df"))), 6).alias("tf_idf"),
    )
)

_WORDS = f"SELECT request_id, CAST(rank AS INTEGER) AS rank, word, {censored('word', True)} AS text, round(score, 6) AS score FROM best_words"
_LINE = f"concat(impact, chr(9), tid, chr(9), {censored('content')})"
_POSTS = f"SELECT request_id, CAST(rank AS INTEGER) AS rank, tid, impact, {censored('content')} AS text, {_LINE} AS line FROM best_posts"


def _topics(t):
    return plan.topics(t.topic_requests, t.topic_posts, t.stop, t.banned)


def _topics_stored(t):
    return plan.topics_of(t.topic_requests, t.topic_summaries, t.topic_posts, t.stop, t.banned)


query("topk_words", _WORDS)(lambda t: _topics_stored(t)[0].withColumn("score", F.round("score", 6)))
query("topk_posts", _POSTS)(lambda t: _topics_stored(t)[1])
_REPORT = f"""SELECT request_id, 'word' AS kind, rank, text, score AS value FROM ({_WORDS}) AS w
  UNION ALL SELECT request_id, 'post', rank, line, CAST(impact AS DOUBLE) FROM ({_POSTS}) AS p"""
query("q_topics", _REPORT)(
    lambda t: plan.report(t.topic_requests, t.topic_posts, t.stop, t.banned, t.topic_summaries).withColumn(
        "value", F.round("value", 6)
    )
)
# The same without anything stored, for requests that are asked once.
query("q_topics_at_once", _REPORT)(
    lambda t: plan.report(t.topic_requests, t.topic_posts, t.stop, t.banned).withColumn("value", F.round("value", 6))
)
query(
    "fn_format_topics",
    """SELECT request_id, string_agg(concat(word, ':', CAST(CAST(round(CAST(score AS DECIMAL(38, 9)), 2) AS DECIMAL(18, 2)) AS VARCHAR)),
  chr(9) ORDER BY rank) AS line FROM best_words GROUP BY 1""",
)(
    lambda t: _topics(t)[0]
    .select("request_id", "rank", text.format_topic(F.col("word"), F.col("score")).alias("entry"))
    # At most n1 words per request are left here.
    .groupBy("request_id")
    .agg(F.array_sort(F.collect_list(F.struct("rank", "entry"))).alias("entries"))
    .select("request_id", F.array_join("entries.entry", "\t").alias("line"))
)
query("fn_tokenize", f"SELECT tid, array_to_string(regexp_extract_all(content, '{TOKEN}'), ' ') AS tokens FROM topic_posts")(
    lambda t: t.topic_posts.select("tid", F.array_join(text.tokens(F.col("content")), " ").alias("tokens"))
)
query(
    "fn_is_word",
    f"""SELECT tid, len(regexp_extract_all(content, '{TOKEN}')) AS tokens, len({words('content')}) AS words FROM topic_posts""",
)(
    lambda t: t.topic_posts.select(
        "tid",
        F.size(text.tokens(F.col("content"))).cast("bigint").alias("tokens"),
        F.size(F.filter(text.tokens(F.col("content")), text.is_word)).cast("bigint").alias("words"),
    )
)
query("fn_censor", f"SELECT tid, {censored('content')} AS text FROM topic_posts")(
    lambda t: t.topic_posts.select("tid", text.censor(F.col("content"), t.banned).alias("text"))
)
# The same with the lists as tables, which may have any length.
query("fn_censor_table", f"SELECT tid, {censored('content')} AS text FROM topic_posts")(
    lambda t: terms.censor(t.topic_posts.select("tid", "content"), t.terms(tuple(t.banned))).select(
        "tid", F.col("content").alias("text")
    )
)
query("fn_impact_table", "SELECT tid, impact, effective FROM impacts")(
    lambda t: ops.with_impact(t.topic_posts, t.terms(tuple(t.stop))).select("tid", "impact", "effective")
)
