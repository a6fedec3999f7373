"""All pairs of users whose shared tags reach a total, whether or not they are in contact.

The total of a pair is the sum over shared tags of both users' uses. Building all pairs of users of every tag is avoided by
prefix filtering. Tags are put in one order, the rarest first. For a tag of a user, `rest` bounds what the tag and all later
ones can add to a pair: own uses plus the most uses of the tag by anyone. Tags whose rest is below the wanted total cannot be
the first tag that a sufficient pair shares; those before form the user's prefix, which holds few and rare tags. A sufficient
pair shares a tag in both prefixes. Pairs that do are checked exactly.

Where the total is small, common tags get into prefixes, and nearly all pairs of their users share one. Storing these pairs
and sending a tag set for each would take space that grows with their square. Users with such a tag are therefore cut into
blocks, a task holds the tag sets of two blocks and hands on the pairs that reach the total, and only tag sets, as many copies
as there are blocks, are ever moved. How common a tag has to be for that is chosen by what has to be moved.

Pairs with any other user are stored and checked one by one. The users of a tag are cut into blocks, and each task compares
two blocks of a tag, so that no tag is a task of its own. A user's tags, one row each, are ordered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from starling.operators.block_totals import Block, totals
from starling.operators.hashtags import shared_tags, tag_sets
from starling.session import materialize

# Users of a tag that are compared in one group with as many others.
BLOCK_USERS = 2_000
# Users whose whole tag sets are compared with those of as many others in one task, and the tags of these.
SET_USERS, SET_USES = 16_000, 500_000
# The set of a user with more tags is not held in a block.
LARGE_TAGS = 50_000
# Fewer users are cut into blocks of this, up to some, for there to be enough tasks.
FEW_USERS, FEW_BLOCKS = 1_000, 8
MOST_TASKS = 10_000
BATCH_PAIRS = 1 << 17


def shareable_tags(counts: DataFrame) -> DataFrame:
    """users and most uses by one of them of each tag, stored, so that joins with a hot tag can be split.

    A tag that one user has is shared by nobody.
    """
    tags = counts.groupBy("tag").agg(F.count("*").alias("users"), F.max("cnt").alias("most"))
    return materialize(tags.where("users > 1"), "shareable-tags").hint("merge")


def prefixes(counts: DataFrame, least: int, tags: DataFrame | None = None) -> DataFrame:
    """uid, tag, users (of the tag) and own (uses of this tag and all later ones) of the tags in the prefix of each user."""
    later = Window.partitionBy("uid").orderBy(F.desc("users"), F.desc("tag")).rowsBetween(Window.unboundedPreceding, 0)
    ordered = counts.join(shareable_tags(counts) if tags is None else tags, "tag")
    ordered = ordered.withColumns({"rest": F.sum(F.col("cnt") + F.col("most")).over(later), "own": F.sum("cnt").over(later)})
    return ordered.where(F.col("rest") >= least).select("uid", "tag", "own")


def candidate_pairs(prefix: DataFrame, least: int, block_users: int = BLOCK_USERS) -> DataFrame:
    """Pairs (lo, hi) that share a tag in both prefixes, and whose uses from there on can reach the total.

    Where prefix says which users are `hot`, pairs of two of these are left out.
    """
    hot = F.col("hot") if "hot" in prefix.columns else F.lit(False)
    sizes = prefix.groupBy("tag").agg(F.ceil(F.count("*") / block_users).cast("int").alias("blocks"))
    placed = prefix.join(sizes, "tag").withColumn("block", F.pmod(F.xxhash64("uid"), "blocks").cast("int"))
    left = placed.select("tag", F.col("uid").alias("a"), F.col("own").alias("own_a"), hot.alias("hot_a"), F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"))
    right = placed.select("tag", F.col("uid").alias("b"), F.col("own").alias("own_b"), hot.alias("hot_b"), F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"))
    # Stored tables pack these rows to a few bytes each, so their size says nothing of what a broadcast of them would hold.
    met = left.join(right.hint("merge"), ["tag", "i", "j"]).where("(i < j OR a < b) AND a <> b AND NOT (hot_a AND hot_b)")
    enough = met.where(F.col("own_a") + F.col("own_b") >= least)
    return enough.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()


def block_count(users: int, uses: int, set_users: int = SET_USERS) -> int:
    """Blocks of so many users with so many tags in all."""
    return max(-(-users // set_users), -(-uses // SET_USES), min(FEW_BLOCKS, -(-users // FEW_USERS)), 1)


def hot_users(users: dict[int, tuple[int, int]], level: int) -> tuple[int, int]:
    """The number and tags of the users whose most common tag is of this level or a higher one."""
    hot = [x for i, x in users.items() if i >= level]
    return sum(n for n, _ in hot), sum(uses for _, uses in hot)


def common_level(tags: dict[int, int], users: dict[int, tuple[int, int]], set_users: int = SET_USERS) -> int:
    """From which level on a tag is common, so that the fewest tag sets are moved.

    A tag that n users have in their prefixes is of level ceil(log2(n)). tags has the pairs of users of the tags of each
    level, users the number and tags of the users whose most common tag is of a level.
    """

    def moved(level: int) -> int:
        hot, uses = hot_users(users, level)
        return sum(n for i, n in tags.items() if i < level) + (hot * block_count(hot, uses, set_users) if hot else 0)

    return min(range(max(tags, default=0) + 2), key=moved)


def _block_pairs(table: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    """The pairs of a block with another one, or within a block."""
    # In the order of users, so that places say which of two is the lower one.
    table = table.take(pc.sort_indices(table["uid"])).combine_chunks()
    uids, block, other = table["uid"].combine_chunks(), table["block"].to_numpy(), table["other"].to_numpy()

    def part(places: np.ndarray) -> Block:
        rows = table.take(pa.array(places))
        sizes = pc.list_value_length(rows["numbers"]).to_numpy()
        return Block(len(places), np.repeat(np.arange(len(places)), sizes), *(pc.list_flatten(rows[c]).to_numpy() for c in ("numbers", "uses")))

    within = block[0] == other[0]
    left, right = np.flatnonzero(block <= other), np.flatnonzero(block >= other)
    if not len(left) or not len(right):
        return
    a = part(left)
    for x, y, total in totals(a, a if within else part(right), least):
        x, y = left[x], right[y]
        if within:
            x, y, total = (z[x < y] for z in (x, y, total))
        for start in range(0, len(x), BATCH_PAIRS):
            p, q = (z[start : start + BATCH_PAIRS] for z in (x, y))
            lo, hi = (uids.take(pa.array(f(p, q))) for f in (np.minimum, np.maximum))
            yield pa.RecordBatch.from_arrays([lo, hi, pa.array(total[start : start + BATCH_PAIRS])], ["lo", "hi", "cnt"])


def pairs_among(sets: DataFrame, least: int, blocks: int) -> DataFrame:
    """lo, hi and cnt of all pairs of users of these stored tag sets (uid, uses by number of tag) that reach the total."""
    block = F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int")
    placed = sets.select("uid", block.alias("block"), F.map_keys("uses").alias("numbers"), F.map_values("uses").alias("uses"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    i, j = F.least("block", "other").cast("long"), F.greatest("block", "other").cast("long")
    met = met.withColumn("pair", (j * (j + 1) / 2).cast("long") + i)
    tasks = min(blocks * (blocks + 1) // 2, MOST_TASKS)
    dealt = met.repartitionById(tasks, (F.col("pair") % tasks).cast("int")).sortWithinPartitions("pair")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pair = [], None
        for batch in batches:
            pairs = batch.column("pair").to_numpy()
            for start, stop in pairwise([0, *(np.flatnonzero(np.diff(pairs)) + 1).tolist(), len(pairs)]):
                if held and stop > start and pairs[start] != pair:
                    yield from _block_pairs(pa.Table.from_batches(held), least)
                    held = []
                if stop > start:
                    pair = pairs[start]
                    held.append(batch.slice(start, stop - start))
        if held:
            yield from _block_pairs(pa.Table.from_batches(held), least)

    uid = sets.schema["uid"].dataType
    return dealt.mapInArrow(run, StructType([StructField("lo", uid), StructField("hi", uid), StructField("cnt", LongType())]))


def pairs_with_large(counts: DataFrame, least: int) -> DataFrame:
    """The same of the pairs with a `large` user, whose tags are looked up one by one."""
    a = counts.where("large").select("tag", F.col("uid").alias("a"), F.col("cnt").alias("cnt_a"))
    b = counts.select("tag", F.col("uid").alias("b"), F.col("cnt").alias("cnt_b"), "large")
    met = a.join(b, "tag").where("a < b OR a > b AND NOT large")
    total = met.groupBy("a", "b").agg(F.sum(F.col("cnt_a") + F.col("cnt_b")).alias("cnt")).where(F.col("cnt") >= least)
    return total.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"), "cnt")


def pairs_above(
    counts: DataFrame, least: int, block_users: int = BLOCK_USERS, set_users: int = SET_USERS, large_tags: int = LARGE_TAGS
) -> DataFrame:
    """lo, hi and cnt of all pairs of different users whose total (at least 1) is at least `least`.

    counts (uid, tag, cnt) has each tag of a user once, and is stored. Stored here are prefixes, the tag sets of users who
    have a common tag in theirs, and the pairs to be checked with any other user.
    """
    if least < 1:
        raise ValueError("pairs without a shared tag are not listed: the total has to be 1 at least")
    tags = shareable_tags(counts)
    prefix = materialize(prefixes(counts, least, tags).where("uid IS NOT NULL"), "prefixes")
    sizes = prefix.groupBy("tag").agg(F.count("*").alias("n")).withColumn("level", F.ceil(F.log2("n")).cast("int"))
    sizes = materialize(sizes, "prefix-tags")
    # As in candidate_pairs, stored rows are many more than their size tells.
    ranked = prefix.join(sizes.select("tag", "level").hint("merge"), "tag")
    most = materialize(ranked.groupBy("uid").agg(F.max("level").alias("most")), "prefix-users")
    shared = counts.join(tags, "tag", "left_semi")
    users = shared.join(most.hint("merge"), "uid").groupBy("uid", "most").agg(F.count("*").alias("uses"))
    users = materialize(users.withColumn("large", F.col("uses") > large_tags), "tag-users")
    # One row for each level.
    met = sizes.groupBy("level").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs"))
    by_tag = {r.level: int(r.pairs) for r in met.collect()}
    grouped = users.groupBy("most", "large").agg(F.count("*").alias("users"), F.sum("uses").alias("uses")).collect()
    by_user = {r.most: (r.users, r.uses) for r in grouped if not r.large}
    level = common_level(by_tag, by_user, set_users)
    hot, uses = hot_users(by_user, level)
    found = []
    common = shared.join(users.where(F.col("most") >= level).select("uid", "large").hint("merge"), "uid")
    if hot:
        sets = tag_sets(common.where("NOT large").drop("large"))
        found.append(pairs_among(sets, least, block_count(hot, uses, set_users)))
    if any(r.large and r.most >= level for r in grouped):
        found.append(pairs_with_large(common, least))
    if any(i < level for i in by_tag):
        rare = ranked.where(F.col("level") < level).join(users.hint("merge"), "uid")
        rare = rare.select("uid", "tag", "own", (F.col("most") >= level).alias("hot"))
        pairs = materialize(candidate_pairs(rare, least, block_users), "pairs")
        found.append(shared_tags(pairs, counts).where(F.col("cnt") >= least))
    if not found:
        return prefix.limit(0).select(F.col("uid").alias("lo"), F.col("uid").alias("hi"), F.lit(0).cast("bigint").alias("cnt"))
    return reduce(DataFrame.unionByName, found)
