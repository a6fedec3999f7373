"""Pairs of users by shared tags against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starling.operators import block_totals, hashtags
from starling.operators import similar_users as ops
from starling.session import materialize


def brute(counts, least):
    own = defaultdict(dict)
    for uid, tag, cnt in counts:
        own[uid][tag] = cnt
    users, out = sorted(own), []
    for i, a in enumerate(users):
        for b in users[i + 1 :]:
            total = sum(own[a][t] + own[b][t] for t in own[a].keys() & own[b].keys())
            if total >= least:
                out.append((a, b, total))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def counts(spark):
    """Half of the users share one hot tag; ties, a very active user, and tags of a single user."""
    rand = random.Random(8)
    rows = {}
    for uid in range(150):
        for _ in range(rand.randrange(12)):
            rows[uid, f"t{int(rand.paretovariate(0.4)) % 60}"] = rand.choice([1, 1, 1, 2, 5])
        if uid % 2:
            rows[uid, "hot"] = rand.choice([1, 3])
        rows[uid, f"only{uid}"] = 9
    rows.update({(7, f"t{i}"): 20 for i in range(60)})
    listed = [(u, t, c) for (u, t), c in rows.items()]
    return spark.createDataFrame(listed, "uid long, tag string, cnt long"), listed


@pytest.mark.parametrize("least", [1, 3, 6, 12, 30, 10_000])
@pytest.mark.parametrize("block_users", [7, 2000])
def test_equals_brute_force(counts, rows, least, block_users):
    table, listed = counts
    assert rows(ops.pairs_above(table, least, block_users), "lo", "hi", "cnt") == brute(listed, least)


def test_prefixes_leave_hot_tags_out(counts):
    table, listed = counts
    table, listed = table.where("uid <> 7"), [r for r in listed if r[0] != 7]
    kept = ops.prefixes(table, 16).where("tag = 'hot'").count()
    assert table.where("tag = 'hot'").count() == 74 and kept < 74 / 2
    few = ops.candidate_pairs(ops.prefixes(table, 16), 16).count()
    assert len(brute(listed, 16)) <= few < len(brute(listed, 1)) / 2


def test_a_hot_tag_is_spread(spark):
    """All users have one tag, which is in all prefixes: no group of blocks holds more than its share."""
    table = spark.range(300).select(F.col("id").alias("uid"), F.lit("hot").alias("tag"), F.lit(1).alias("cnt"))
    assert ops.pairs_above(table, 2, block_users=30).count() == 300 * 299 // 2
    assert ops.pairs_above(table, 3, block_users=30).count() == 0
    with pytest.raises(ValueError):
        ops.pairs_above(table, 0)


def test_prefixes_are_not_broadcast(spark, counts):
    """Stored they are small, and many times that in memory."""
    prefix = ops.materialize(ops.prefixes(counts[0], 6), "prefixes")
    plan = ops.candidate_pairs(prefix, 6)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "i#" in line and "j#" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_pairs_of_common_tags_are_not_stored(spark, rows, monkeypatch):
    """Most pairs share a tag, few reach the total: what is stored grows with the users, and not with their pairs."""
    stored = {}

    def count(df, label):
        out = materialize(df, label)
        stored[label] = out.count()
        return out

    monkeypatch.setattr(ops, "materialize", count)
    monkeypatch.setattr(hashtags, "materialize", count)
    rand = random.Random(5)
    listed = [(uid, f"t{t}", 2) for uid in range(300) for t in rand.sample(range(12), 6)]
    table = spark.createDataFrame(listed, "uid long, tag string, cnt long")
    assert rows(ops.pairs_above(table, 17), "lo", "hi", "cnt") == brute(listed, 17)
    assert stored and max(stored.values()) <= len(listed)


@pytest.mark.parametrize("level", [0, 2, 5, 99])
@pytest.mark.parametrize("large_tags", [3, 50_000])
def test_common_from_any_level_on(counts, rows, monkeypatch, level, large_tags):
    """Users with common tags are compared by blocks, all other pairs one by one: together these are all pairs once."""
    table, listed = counts
    used = []
    for name in ("pairs_among", "pairs_with_large", "candidate_pairs"):
        monkeypatch.setattr(ops, name, lambda *args, f=getattr(ops, name), name=name: used.append(name) or f(*args))
    monkeypatch.setattr(ops, "common_level", lambda *_: level)
    # Several pairs of blocks in a task.
    monkeypatch.setattr(ops, "MOST_TASKS", 3)
    got = ops.pairs_above(table, 6, block_users=40, set_users=30, large_tags=large_tags)
    assert rows(got, "lo", "hi", "cnt") == brute(listed, 6)
    by_blocks = {"pairs_among"} | ({"pairs_with_large"} if large_tags == 3 else set())
    assert set(used) == {0: by_blocks, 99: {"candidate_pairs"}}.get(level, by_blocks | {"candidate_pairs"})


def test_odd_users_and_tags(spark, rows):
    """A null user or tag is in no pair, and users may be numbers or texts."""
    listed = [("b", "x", 2), ("a", "x", 3), ("é", "x", 1), (None, "x", 9), ("a", None, 9), ("b", None, 9)]
    table = spark.createDataFrame(listed, "uid string, tag string, cnt long")
    assert rows(ops.pairs_above(table, 4), "lo", "hi", "cnt") == [("a", "b", 5), ("a", "é", 4)]
    none = ops.pairs_above(table.where("tag IS NULL"), 4)
    assert none.dtypes == [("lo", "string"), ("hi", "string"), ("cnt", "bigint")] and none.count() == 0


def test_the_level_that_moves_least():
    """A tag of many users is common, unless few pairs share one and users are many."""
    assert ops.common_level({10: 500_000}, {10: (1_000, 1_000)}) <= 10
    assert ops.common_level({1: 1_000}, {1: (1_000_000, 2_000_000)}) == 2
    assert 1 < ops.common_level({1: 1_000, 10: 500_000}, {1: (1_000_000, 2_000_000), 10: (1_000, 2_000)}) <= 10
    assert ops.common_level({}, {}) == 0


@pytest.mark.parametrize("scale", [1, 1 << 25, 1 << 60])
@pytest.mark.parametrize("cells", [5, 1 << 21])
def test_totals_of_blocks(monkeypatch, scale, cells):
    """Common and rare tags, in steps of any size, also where totals need more digits than a float has."""
    monkeypatch.setattr(block_totals, "CELLS", cells)
    rand, sides = random.Random(4), []
    for users in (17, 30):
        tags = [sorted({0, *(rand.choice([1, 2, rand.randrange(3, 4000)]) for _ in range(i % 7))}) for i in range(users)]
        tags[3] = []
        sides.append([{t: scale + rand.randrange(3) for t in own} for own in tags])
    blocks = [
        block_totals.Block(len(side), *(np.array(x) for x in zip(*[(i, t, n) for i, own in enumerate(side) for t, n in own.items()])))
        for side in sides
    ]
    want = {(i, j): sum(a[t] + b[t] for t in a.keys() & b.keys()) for i, a in enumerate(sides[0]) for j, b in enumerate(sides[1])}
    got = [x for step in block_totals.totals(*blocks, scale * 4) for x in zip(*(z.tolist() for z in step))]
    assert sorted(got) == sorted((i, j, n) for (i, j), n in want.items() if n >= scale * 4)
