"""Topic words and top posts for a table of requests (request_id, ranges of users and times, n1, n2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starling.functions.text import censor, format_post
from starling.operators import summaries, terms
from starling.operators import topics as ops
from starling.operators.dedup import first_rows, newest_first
from starling.operators.ranges import range_join
from starling.session import materialize


# Parts in which the rows of a request are ranked first.
PARTS = 32


def _top(df: DataFrame, key: str, order: list, limits: DataFrame, limit: str, most: int) -> DataFrame:
    """The first rows of each request, as many as it asks for.

    Rows of a request are ranked in PARTS parts first, by a hash of their key, and the first of each part are ranked
    together: one task sees PARTS times `most`, the largest number asked for, whatever the request holds. Up to
    Spark's threshold of 1,000 each task cuts its rows before the shuffle as well. The own limit comes last.
    """
    parts = Window.partitionBy("request_id", F.pmod(F.xxhash64(key), F.lit(PARTS))).orderBy(*order)
    first = df.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= most).drop("rank")
    window = Window.partitionBy("request_id").orderBy(*order)
    ranked = first.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= most)
    own = limits.select("request_id", F.col(limit).alias("_limit"))
    return ranked.join(own, "request_id").where("rank <= _limit").drop("_limit")


def hits(requests: DataFrame, posts: DataFrame) -> DataFrame:
    """Posts of each request, one per tid."""
    found = range_join(requests, posts)
    return materialize(first_rows(found, ["request_id", "tid"], newest_first(found, ["request_id", "tid"])), "hits")


def _limits(requests: DataFrame) -> tuple[int, int]:
    most = requests.agg(F.max("n1").alias("n1"), F.max("n2").alias("n2")).first()
    return most.n1 or 0, most.n2 or 0


def top_words(requests: DataFrame, found: DataFrame, stop: ops.Terms) -> DataFrame:
    scored = ops.request_topic_scores(found, stop)
    return _top(scored, "word", ops.rank_words(), requests, "n1", _limits(requests)[0])


def top_posts(requests: DataFrame, found: DataFrame, words: DataFrame, stop: ops.Terms) -> DataFrame:
    """Posts with any of the request's topic words, by impact. The words are at most n1 per request."""
    wanted = words.groupBy("request_id").agg(F.collect_list("word").alias("_terms"))
    joined = found.join(wanted, "request_id")
    matching = joined.where(ops.has_any(F.col("content"), F.col("_terms"))).drop("_terms")
    valued = ops.with_impact(matching, stop)
    return _top(valued, "tid", ops.rank_posts(), requests, "n2", _limits(requests)[1])


def topics(
    requests: DataFrame, posts: DataFrame, stop: ops.Terms, banned: ops.Terms
) -> tuple[DataFrame, DataFrame]:
    """Ranked topic words and ranked posts of each request, banned words starred out."""
    found = hits(requests, posts)
    # A few rows per request, read again to select the posts.
    words = materialize(top_words(requests, found, stop), "words")
    best = top_posts(requests, found, words, stop)
    return _shown(words, best, banned)


def topics_of(
    requests: DataFrame, stored: summaries.Summaries, posts: DataFrame, stop: ops.Terms, banned: ops.Terms
) -> tuple[DataFrame, DataFrame]:
    """The same from stored sums and index of the posts, unique by tid: of posts, only the texts of the ranked ones are read."""
    words, posts_most = _limits(requests)
    split, edges = summaries.asked(requests, stored)
    scored = summaries.request_scores(split, edges, stored, stop)
    words = materialize(_top(scored, "word", ops.rank_words(), requests, "n1", words), "words")
    matching = summaries.posts_with_words(words, split, stored)
    best = _top(matching, "tid", ops.rank_posts(), requests, "n2", posts_most)
    return _shown(words, best.join(posts.select("tid", "content"), "tid"), banned)


def _shown(words: DataFrame, best: DataFrame, banned: ops.Terms) -> tuple[DataFrame, DataFrame]:
    def masked(df: DataFrame, column: str, mask_last: bool) -> DataFrame:
        if isinstance(banned, DataFrame):
            return terms.censor(df.withColumn("text", F.col(column)), banned, "text", mask_last)
        return df.withColumn("text", censor(F.col(column), banned, mask_last))

    # A word is always followed by its score in the report, so it never ends the text.
    words = masked(words, "word", True)
    best = masked(best, "content", False)
    return (
        words.select("request_id", "rank", "word", "text", "score"),
        best.select("request_id", "rank", "tid", "impact", "text", format_post(*map(F.col, ("impact", "tid", "text"))).alias("line")),
    )


def report(
    requests: DataFrame,
    posts: DataFrame,
    stop: ops.Terms,
    banned: ops.Terms,
    stored: summaries.Summaries | None = None,
) -> DataFrame:
    """Both lists in one table: kind is `word` or `post`, value the score or the impact. From stored sums, if given."""
    words, best = topics_of(requests, stored, posts, stop, banned) if stored else topics(requests, posts, stop, banned)
    impact = F.col("impact").cast("double").alias("value")
    return words.select(
        "request_id", F.lit("word").alias("kind"), "rank", "text", F.col("score").alias("value")
    ).unionByName(best.select("request_id", F.lit("post").alias("kind"), "rank", F.col("line").alias("text"), impact))
