"""Score formulas. All logarithms are natural."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: shared tags up to this total do not raise a contact's score.
FREE_OVERLAP = 10


def keyword_score(phrase_matches: Column, tag_matches: Column) -> Column:
    return 1 + F.log(phrase_matches + tag_matches + F.lit(1.0))


def hashtag_score(overlap: Column) -> Column:
    return F.when(overlap > FREE_OVERLAP, 1 + F.log(overlap - F.lit(FREE_OVERLAP - 1.0))).otherwise(F.lit(1.0))


def interaction_score(interactions: Column) -> Column:
    return 1 + F.log(interactions + F.lit(1.0))


def contact_score(keyword: Column, hashtag: Column, interaction: Column) -> Column:
    return keyword * hashtag * interaction


def term_frequency(count: Column, words_in_post: Column) -> Column:
    return count / words_in_post


def inverse_frequency(posts: Column, posts_with_word: Column) -> Column:
    return F.log(posts / posts_with_word)


def tf_idf(count: Column, words_in_post: Column, posts: Column, posts_with_word: Column) -> Column:
    return term_frequency(count, words_in_post) * inverse_frequency(posts, posts_with_word)


def impact(effective_words: Column, favorites: Column, shares: Column, followers: Column) -> Column:
    """Effective words times all engagement; missing counts are zero."""
    engagement = [F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint")) for c in (favorites, shares, followers)]
    return effective_words.cast("bigint") * (engagement[0] + engagement[1] + engagement[2])


def impact_weight(impact_value: Column) -> Column:
    return F.log(impact_value + F.lit(1.0))
