"""Tags of users and the tags two users share.

Tables of terms are joined without a hint: Spark broadcasts them while their size stays under its threshold
and shuffles them beyond.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.text import split_tags
from starling.operators.documents import PAGE_ROWS, concatenate
from starling.session import materialize

# A set of more tags than this is not sent whole.
SET_TAGS = 1_000


def drop_terms(df: DataFrame, terms: DataFrame, column: str = "tag") -> DataFrame:
    """Rows whose lower-cased value is not among the terms."""
    return df.join(terms.select(F.col("term").alias("_term")), F.lower(column) == F.col("_term"), "left_anti")


def tags(posts: DataFrame, *columns: str) -> DataFrame:
    """One lower-cased tag of a sender per row, with its position and the named columns."""
    return posts.select(
        F.col("sender_uid").alias("uid"), *columns, F.posexplode(split_tags(F.col("hashtags"))).alias("pos", "tag")
    ).withColumn("tag", F.lower("tag"))


def tag_counts(posts: DataFrame, popular: DataFrame) -> DataFrame:
    """Uses of each unpopular tag by each user.

    Counted before the popular tags are dropped: what is left to join is one row per user and tag of a task, and
    popular tags, the hot ones, have been combined by then.
    """
    counted = tags(posts).groupBy("uid", "tag").agg(F.count("*").alias("cnt"))
    return drop_terms(counted, popular)


def user_tags(posts: DataFrame, popular: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """All unpopular tags of each user as comma text, in order of time."""
    kept = drop_terms(tags(posts, "timestamp", "tid"), popular)
    joined = concatenate(kept, ["uid"], ["timestamp", "tid", "pos"], ["tag"], page_rows=page_rows)
    return joined.select(F.col("uid").alias("sender_uid"), "part", F.col("tag").alias("hashtags"))


def _sized(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """lo and hi of the pairs whose users both have tags, with `probe`, the one with fewer tags, `other`, and the tags of other."""
    lo = sizes.select(F.col("uid").alias("lo"), F.col("n").alias("n_lo"))
    hi = sizes.select(F.col("uid").alias("hi"), F.col("n").alias("n_hi"))
    fewer = F.col("n_lo") <= F.col("n_hi")
    return pairs.select("lo", "hi").join(lo, "lo").join(hi, "hi").select(
        "lo",
        "hi",
        F.when(fewer, F.col("lo")).otherwise(F.col("hi")).alias("probe"),
        F.when(fewer, F.col("hi")).otherwise(F.col("lo")).alias("other"),
        F.greatest("n_lo", "n_hi").alias("n_other"),
    )


def _shared_by_rows(ends: DataFrame, counts: DataFrame) -> DataFrame:
    """Totals of pairs, one tag of the probe a row."""
    probe = counts.select(F.col("uid").alias("probe"), "tag", F.col("cnt").alias("probe_cnt"))
    other = counts.select(F.col("uid").alias("other"), "tag", F.col("cnt").alias("other_cnt"))
    matched = ends.join(probe, "probe").join(other, ["other", "tag"])
    return matched.groupBy("lo", "hi").agg(F.sum(F.col("probe_cnt") + F.col("other_cnt")).alias("cnt"))


def tag_sets(counts: DataFrame) -> DataFrame:
    """The tags of each user as one map, stored: uses by the number of the tag."""
    tags = counts.select("tag").where("tag IS NOT NULL").distinct()
    # Numbers are fixed once they are stored.
    named = materialize(tags.withColumn("number", F.monotonically_increasing_id()), "tag-numbers")
    entries = F.collect_list(F.struct("number", "cnt"))
    sets = counts.join(named, "tag").groupBy("uid").agg(F.map_from_entries(entries).alias("uses"))
    return materialize(sets, "tag-sets")


def _shared_by_sets(ends: DataFrame, counts: DataFrame) -> DataFrame:
    """Totals of pairs, whole tag sets side by side: one row a pair goes to the other user, and tags go as numbers."""
    sets = tag_sets(counts)
    probe = sets.select(F.col("uid").alias("probe"), F.col("uses").alias("_probe"))
    other = sets.select(F.col("uid").alias("other"), F.col("uses").alias("_other"))
    both = F.map_values(F.map_zip_with("_probe", "_other", lambda _, x, y: x + y))
    # Null, and not 0, where no tag is shared.
    total = F.aggregate(both, F.lit(None).cast("bigint"), lambda acc, x: F.coalesce(acc + x, acc, x))
    met = ends.select("lo", "hi", "probe", "other").join(probe, "probe").join(other, "other")
    # As the output of a generator the total is taken once per row, and not again by the filter.
    return met.select("lo", "hi", F.explode(F.array(total)).alias("cnt")).where("cnt IS NOT NULL")


def shared_tags(pairs: DataFrame, counts: DataFrame, set_tags: int = SET_TAGS) -> DataFrame:
    """Per given pair (lo, hi), the sum over shared tags of both users' uses; pairs with none are left out.

    Pairs are distinct, and counts have each tag of a user once. For each pair the tags of the user with fewer tags are sent
    to the other, as one row, where both sets are compared. Where the other has more than `set_tags` tags, those of the
    first are looked up among them one by one. The work is the sum over pairs of the smaller tag set, or of two sets of at
    most `set_tags`: a user with very many contacts or tags costs no more than its contacts' few tags, and no tag ever
    meets all pairs of its users.
    """
    sizes = materialize(counts.groupBy("uid").agg(F.count("*").alias("n")), "tag-users")
    ends = _sized(pairs, sizes)
    # A short list, of known size.
    large = materialize(sizes.where(F.col("n") > set_tags).select("uid"), "large-tag-users")
    small = counts.join(large, "uid", "left_anti")
    if large.isEmpty():
        return _shared_by_sets(ends, small)
    ends = materialize(ends, "tag-pairs")
    many = F.col("n_other") > set_tags
    return _shared_by_sets(ends.where(~many), small).unionByName(_shared_by_rows(ends.where(many), counts))


def shared_hashtag_pairs(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """Shared-tag totals of distinct users among the given pairs."""
    return shared_tags(pairs.where("lo <> hi"), counts)


def contact_overlap(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """The shared-tag total of every given pair: 0 where there is none, twice the own total for a user itself."""
    shared = shared_tags(pairs, counts).withColumnRenamed("cnt", "overlap")
    joined = pairs.select("lo", "hi").join(shared, ["lo", "hi"], "left")
    return joined.withColumn("overlap", F.coalesce("overlap", F.lit(0)))
