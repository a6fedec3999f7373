"""Words of posts, their scores, and the impact of posts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions import scores
from starling.functions.text import strip_urls, tokens, words
from starling.operators import terms
from starling.session import materialize

# Scores that differ by less than this many digits rank as equal: sums of doubles depend on their order.
RANK_DIGITS = 9

Terms = Sequence[str] | DataFrame


def post_words(text: Column) -> Column:
    """The words of a post that count for scores: those outside links."""
    return words(strip_urls(text))


def with_words(posts: DataFrame) -> DataFrame:
    """Add `words`. As the output of a generator they are taken once per row, however often they are used."""
    return posts.select("*", F.explode(F.array(post_words(F.col("content")))).alias("words"))


def term_counts(posts: DataFrame) -> DataFrame:
    """Occurrences per post and word, and the number of words of the post.

    A post has all its words in its row, so they are sorted and counted there: no task holds more than one post. Only
    rows whose tid occurs again are counted together, by a shuffle.
    """
    again = posts.groupBy("tid").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("tid").alias("_tid"))
    again = materialize(again, "repeated-tids")
    same = F.col("tid").eqNullSafe(F.col("_tid"))
    alone = _counted_in_rows(posts.select("tid", "content").join(again, same, "left_anti"))
    if again.isEmpty():
        return alone
    length = F.size("words").cast("bigint").alias("doc_len")
    repeated = with_words(posts.select("tid", "content").join(again, same, "left_semi"))
    exploded = repeated.select("tid", length, F.explode("words").alias("word"))
    counted = exploded.groupBy("tid", "doc_len", "word").agg(F.count("*").alias("cnt"))
    return alone.unionByName(counted.select("tid", "word", "cnt", "doc_len"))


def _counted_in_rows(posts: DataFrame) -> DataFrame:
    """tid, word, cnt and doc_len of each row by itself: equal words stand together in its sorted words."""
    ordered = posts.select("tid", F.explode(F.array(F.array_sort(post_words(F.col("content"))))).alias("words"))
    ordered = ordered.where(F.size("words") > 0)
    places = F.transform("words", lambda w, i: F.when((i == 0) | (w != F.get("words", i - 1)), i))
    firsts = ordered.select("tid", "words", F.explode(F.array(F.array_compact(places))).alias("firsts"))
    length = F.size("words")
    runs = F.transform(
        "firsts",
        lambda at, i: F.struct(F.get("words", at).alias("word"), (F.coalesce(F.get("firsts", i + 1), length) - at).cast("bigint").alias("cnt")),
    )
    return firsts.select("tid", F.inline(runs), length.cast("bigint").alias("doc_len")).select("tid", "word", "cnt", "doc_len")


def doc_freq(posts: DataFrame) -> DataFrame:
    """Posts per word: distinct words are taken within each row, so counts combine before the shuffle."""
    return posts.select(F.explode(F.array_distinct(post_words(F.col("content")))).alias("word")).groupBy("word").agg(
        F.count("*").alias("df")
    )


def with_impact(posts: DataFrame, stop: Terms) -> DataFrame:
    """Add the words, the number of effective words and the impact of each post.

    Stop words are a list, or a table of any size, here and below.
    """
    if isinstance(stop, DataFrame):
        rows = terms.numbered(with_words(posts))
        joined = rows.join(terms.counted(rows, stop), "_row", "left")
        effective = (F.size("words") - F.coalesce("_stopped", F.lit(0))).cast("bigint")
        return joined.withColumn("effective", effective).withColumn("impact", impact_of()).drop("_row", "_stopped")
    effective = F.size(F.filter("words", lambda w: ~w.isin(*stop))) if stop else F.size("words")
    counted = with_words(posts).withColumn("effective", effective.cast("bigint"))
    return counted.withColumn("impact", impact_of())


def impact_of() -> Column:
    return scores.impact(F.col("effective"), F.col("favorite_count"), F.col("retweet_count"), F.col("followers_count"))


def word_weights(posts: DataFrame, stop: Terms, keys: Sequence[str] = ()) -> DataFrame:
    """Per word the posts that have it and the sum of tf * ln(impact + 1); one shuffle.

    The idf of a word is the same in all posts, so it can wait until after the sum. Each occurrence of a word adds
    1 / words-in-post to its tf, so occurrences are summed as they are, and each distinct word of a post adds one to
    the document frequency. Both go through one aggregate that combines in the task: what is shuffled is the
    vocabulary of a task, not its words.
    """
    return weights_of(with_impact(posts, stop), stop, keys)


def weights_of(valued: DataFrame, stop: Terms, keys: Sequence[str] = ()) -> DataFrame:
    """The same from posts that have their words and impact."""
    share = scores.impact_weight(F.col("impact")) / F.nullif(F.size("words"), F.lit(0))
    shared = valued.withColumn("_share", share)
    none, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    occurrences = F.transform("words", lambda w: F.struct(w.alias("word"), F.col("_share").alias("w"), none.alias("d")))
    distinct = F.transform(
        F.array_distinct("words"), lambda w: F.struct(w.alias("word"), F.lit(0.0).alias("w"), one.alias("d"))
    )
    rows = shared.select(*keys, F.inline(F.concat(occurrences, distinct)))
    if isinstance(stop, DataFrame):
        kept = terms.without(rows, stop)
    else:
        kept = rows.where(~F.col("word").isin(*stop)) if stop else rows
    return kept.groupBy(*keys, "word").agg(F.sum("w").alias("weight"), F.sum("d").alias("df"))


def topic_scores(posts: DataFrame, stop: Terms) -> DataFrame:
    """Score of each word that is no stop word: the sum over posts of tf * ln(N / df) * ln(impact + 1).

    N counts all given posts, also those without a word.
    """
    total = posts.select(F.count("*")).scalar()
    return scored(word_weights(posts, stop).withColumn("n", total), ())


def request_topic_scores(hits: DataFrame, stop: Terms) -> DataFrame:
    """The same per request. N is one row per request."""
    sizes = corpus_size(hits)
    weights = word_weights(hits, stop, ["request_id"])
    return scored(weights.join(sizes, "request_id"), ["request_id"])


def scored(weights: DataFrame, keys: Sequence[str]) -> DataFrame:
    score = F.col("weight") * scores.inverse_frequency(F.col("n"), F.col("df"))
    return weights.select(*keys, "word", "df", "n", score.alias("score"))


def corpus_size(hits: DataFrame) -> DataFrame:
    """Posts per request."""
    return hits.groupBy("request_id").agg(F.count("*").alias("n"))


def rank_words() -> list[Column]:
    return [F.round("score", RANK_DIGITS).desc(), F.col("word").asc()]


def rank_posts() -> list[Column]:
    return [F.col("impact").desc(), F.col("tid").desc()]


def posts_with_terms(posts: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Posts that have any of the lower-case terms; links are searched too."""
    return posts.where(has_any(F.col("content"), F.array(*[F.lit(t) for t in wanted]).cast("array<string>")))


def has_any(text: Column, wanted: Column) -> Column:
    return F.arrays_overlap(F.transform(tokens(text), F.lower), wanted)
