import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starling.operators import documents, graph, hashtags, lookup, quality
from starling.operators.split_points import split_points
from starling.plans.combined import combined


@pytest.fixture
def small(posts_of):
    return posts_of(
        (1, 10, "a", 2, 1, None, "x"),
        (2, 20, "b", 1, 2, None, "y"),
        (3, 30, "c", None, 1, 2, "x,y"),
        (4, 40, "d", 3, 3, None, "z"),
        (5, 50, "e", 4, 1, 4, "x"),
        (6, 60, "f", None, 9, None, "x"),
    )


def test_interactions(small, rows):
    expected = [(1, 2, 5), (1, 4, 3), (3, 3, 2)]
    assert rows(graph.interactions(small)) == expected
    assert rows(graph.interactions_by_join(small), "lo", "hi", "cnt") == expected


def test_latest_contact(small, posts_of, rows):
    assert rows(graph.latest_contact(small), "lo", "hi", "content") == [(1, 2, "c"), (1, 4, "e"), (3, 3, "d")]
    tie = posts_of((1, 10, "a", 2, 1, None, ""), (2, 10, "b", 1, 2, None, ""))
    assert rows(graph.latest_contact(tie), "content") == [("b",)]


def test_contact_docs_double_posts_to_oneself(small, rows):
    docs = rows(documents.reply_docs(small), "uid", "contact_uid", "content", "hashtags")
    assert (3, 3, "d,d", "z,z") in docs
    assert (1, 2, "a,b", "x,y") in docs and (2, 1, "a,b", "x,y") in docs


def test_pages_in_order_are_the_document(spark):
    rng = random.Random(1)
    # One key holds a third of all rows.
    data = [(0 if i % 3 == 0 else rng.randrange(1, 40), i, rng.randrange(50), f"p{i}") for i in range(900)]
    df = spark.createDataFrame(data, "k long, tid long, timestamp long, content string")
    got = documents.concatenate(df, ["k"], ["timestamp", "tid"], ["content"], page_rows=40).collect()
    pages = defaultdict(dict)
    for row in got:
        pages[row.k][row.part] = row.content.split(",")
    for key, held in pages.items():
        want = [c for k, _, _, c in sorted(data, key=lambda r: (r[2], r[1])) if k == key]
        assert sorted(held) == list(range(len(held)))
        assert [c for part in sorted(held) for c in held[part]] == want
        assert all(len(held[part]) == 40 for part in sorted(held)[:-1])
    assert len(pages[0]) == 8


def test_user_tags_keep_time_order_and_drop_popular_ones(posts_of, terms_of, rows):
    posts = posts_of(
        (2, 20, "b", None, 1, None, "C,Hot"), (1, 10, "a", None, 1, None, "B,a,B"), (3, 5, "c", None, 2, None, "hot")
    )
    assert rows(hashtags.user_tags(posts, terms_of("hot"))) == [(1, 0, "b,a,b,c")]
    assert rows(hashtags.tag_counts(posts, terms_of("hot"))) == [(1, "a", 1), (1, "b", 2), (1, "c", 1)]


def test_shared_tags(posts_of, terms_of, spark, rows):
    posts = posts_of(
        (1, 1, "", None, 1, None, "t,T,pop"), (2, 1, "", None, 2, None, "t,t,t,POP"), (3, 1, "", None, 3, None, "u")
    )
    counts = hashtags.tag_counts(posts, terms_of("pop"))
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 1), (1, 9)], "lo long, hi long")
    assert rows(hashtags.contact_overlap(pairs, counts)) == [(1, 1, 4), (1, 2, 5), (1, 3, 0), (1, 9, 0)]
    assert rows(hashtags.shared_hashtag_pairs(pairs, counts)) == [(1, 2, 5)]


def test_shared_tags_with_a_hot_user_and_a_hot_tag(spark, rows):
    rng = random.Random(3)
    counts = {(u, f"t{t}"): rng.randrange(1, 5) for u in range(1, 60) for t in rng.sample(range(30), 4)}
    counts |= {(u, "hot"): 1 for u in range(0, 60, 2)} | {(0, f"t{t}"): 2 for t in range(30)}
    pairs = {(0, u) for u in range(60)} | {tuple(sorted(rng.sample(range(60), 2))) for _ in range(200)}
    frame = spark.createDataFrame([(u, t, n) for (u, t), n in counts.items()], "uid long, tag string, cnt long")
    got = rows(hashtags.contact_overlap(spark.createDataFrame(sorted(pairs), "lo long, hi long"), frame))
    tags = defaultdict(dict)
    for (u, t), n in counts.items():
        tags[u][t] = n
    expected = [(a, b, sum(tags[a][t] + tags[b][t] for t in tags[a].keys() & tags[b].keys())) for a, b in pairs]
    assert got == sorted(expected, key=repr)


def test_combined_matches_a_plain_computation(small, spark, terms_of, rows):
    users = spark.createDataFrame([(1, "one", None), (2, "two", "d2")], "uid long, screen_name string, description string")
    got = rows(combined(small, users, terms_of("y")), "uid", "contact_uid", "type", "interaction", "latest_post",
               "hashtag_cnt", "hashtags", "content", "screen_name", "description")
    assert got == sorted(
        [
            (1, 2, 0, 5, "c", 0, "x,y", "a,b", "two", "d2"),
            (2, 1, 0, 5, "c", 0, "x,y", "a,b", "one", ""),
            (1, 2, 1, 5, "c", 0, "x,y", "c", "two", "d2"),
            (2, 1, 1, 5, "c", 0, "x,y", "c", "one", ""),
            (3, 3, 0, 2, "d", 2, "z,z", "d,d", "", ""),
            (1, 4, 0, 3, "e", 0, "x", "e", "", ""),
            (4, 1, 0, 3, "e", 0, "x", "e", "one", ""),
            (1, 4, 1, 3, "e", 0, "x", "e", "", ""),
            (4, 1, 1, 3, "e", 0, "x", "e", "one", ""),
        ],
        key=repr,
    )


def test_mirror_can_give_self_pairs_once(spark, rows):
    pairs = spark.createDataFrame([(1, 2, 7), (3, 3, 8)], "lo long, hi long, cnt long")
    assert rows(graph.mirror(pairs, "lo", "hi", self_twice=False)) == [(1, 2, 7), (2, 1, 7), (3, 3, 8)]
    assert len(rows(graph.mirror(pairs, "lo", "hi"))) == 4


def test_lookups(spark, rows):
    df = spark.createDataFrame([(1, 2, 0, "p"), (1, 3, 1, "q"), (2, 1, 0, "r")], "uid long, contact_uid long, type int, c string")
    assert len(rows(lookup.lookup_contacts_by_type(df, 1, "reply"))) == 1
    assert len(rows(lookup.lookup_contacts_by_type(df, 1, "anything"))) == 2
    keys = spark.createDataFrame([(1, 2), (1, 2), (5, 5)], "uid long, contact_uid long")
    assert rows(lookup.patch(df, keys, "c", F.concat("c", F.lit(" "))), "c") == [("p ",), ("q",), ("r",)]
    assert rows(lookup.filter_keys(df, keys), "c") == [("p",)]
    pairs = spark.createDataFrame([(1, 2, 3), (2, 9, 4)], "lo long, hi long, cnt long")
    assert rows(lookup.lookup_pairs(pairs, ["2_9", "7_8", "2_9"]), "cnt") == [(4,)]


def test_check_numeric(spark, rows):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("1.5",)], "t string")
    assert rows(quality.check_numeric(df, "t")) == [("1.5",), ("x",)]


@pytest.mark.parametrize("parts", [2, 7, 10])
def test_split_points_with_a_hot_key(spark, rows, parts):
    rng = random.Random(parts)
    keys = [5000 if i % 3 == 0 else rng.randrange(10000) for i in range(2000)]
    df = spark.createDataFrame([(k,) for k in keys], "uid long")
    ordered, n = sorted(keys), len(keys)
    ranks = [int(i * n / parts + 0.5) for i in range(1, parts)]
    assert rows(split_points(df, "uid", parts)) == sorted(((r, ordered[r - 1]) for r in ranks), key=repr)
    texts = sorted(str(k) for k in keys)
    got = split_points(df.select(F.col("uid").cast("string").alias("t")), "t", parts)
    assert rows(got) == sorted(((r, texts[r - 1]) for r in ranks), key=repr)


def test_split_points_of_nothing(spark, rows):
    assert rows(split_points(spark.createDataFrame([], "uid long"), "uid", 5)) == []


def test_tag_sets_give_the_totals_of_single_tags(spark, rows):
    """Sets go whole up to a number of tags and are looked up one by one beyond it; a tag of no name is shared by nobody."""
    rng = random.Random(3)
    uses = {(u, f"t{rng.randrange(30)}"): rng.randrange(1, 4) for u in range(20) for _ in range(u)}
    listed = [(*k, n) for k, n in uses.items()] + [(3, None, 5), (4, None, 5)]
    counts = spark.createDataFrame(listed, "uid long, tag string, cnt long")
    pairs = [(a, b) for a in range(20) for b in range(a, 20)]
    want = []
    for a, b in pairs:
        shared = [(t, n) for (u, t), n in uses.items() if u == a and (b, t) in uses]
        if shared:
            want.append((a, b, sum(n + uses[b, t] for t, n in shared)))
    table = spark.createDataFrame(pairs, "lo long, hi long")
    for most in (0, 6, 1000):
        assert rows(hashtags.shared_tags(table, counts, most), "lo", "hi", "cnt") == sorted(want, key=repr)


def test_rows_of_short_documents_are_moved_once(spark):
    """No sort and no numbers for keys of one page."""
    df = spark.createDataFrame([(k, t, "x") for k in range(5) for t in range(4)], "k long, t long, content string")
    plan = documents.concatenate(df, ["k"], ["t"], ["content"], page_rows=4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" not in plan
    got = documents.concatenate(df.where("k < 2 OR t < 3"), ["k"], ["t"], ["content"], page_rows=3).collect()
    assert sorted((r.k, r.part, r.content) for r in got) == [
        (0, 0, "x,x,x"), (0, 1, "x"), (1, 0, "x,x,x"), (1, 1, "x"), (2, 0, "x,x,x"), (3, 0, "x,x,x"), (4, 0, "x,x,x")
    ]
