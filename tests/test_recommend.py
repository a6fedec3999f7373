import math
import random

import pytest
from pyspark.sql import functions as F

from starling.functions.text import count_matches
from starling.plans import recommend as rec
from starling.plans import serving
from starling.plans.combined import combined


@pytest.fixture
def requests_of(spark):
    columns = "request_id int, uid long, type string, phrase string, hashtag string"
    return lambda *items: spark.createDataFrame(list(items), columns)


@pytest.fixture
def users(spark):
    return spark.createDataFrame([(2, "two", None)], "uid long, screen_name string, description string")


def test_scores_and_lines(posts_of, requests_of, users, terms_of, rows):
    posts = posts_of(
        (1, 10, "go go", 2, 1, None, "Tag,x"),
        (2, 20, "Go", None, 2, 1, "tag"),
        (3, 30, "go", None, 5, 6, "tag"),
    )
    asked = requests_of((1, 1, "reply", "go", "TAG"), (2, 1, "retweet", "go", "tag"), (3, 1, "any", "go", "tag"))
    got = rows(rec.recommend(asked, posts, users, terms_of("x")), "request_id", "matches", "interaction", "overlap", "line")
    line = "2\ttwo\t\tGo"
    assert got == [(1, 3, 3, 2, line), (2, 1, 3, 2, line), (3, 4, 3, 2, line)]
    score = rec.recommend(requests_of((3, 1, "any", "go", "tag")), posts, users, terms_of("x")).first().score
    assert score == pytest.approx((1 + math.log(5)) * (1 + math.log(4)))


def test_only_contacts_of_the_asked_type(posts_of, requests_of, users, terms_of, rows):
    posts = posts_of((1, 10, "a", 2, 1, None, "t"), (2, 20, "b", None, 1, 3, "t"))
    got = rows(rec.recommend(requests_of((1, 1, "retweet", "", "")), posts, users, terms_of()), "contact_uid", "interaction")
    assert got == [(3, 1)]


def test_equal_scores_rank_the_larger_user_first(posts_of, requests_of, users, terms_of):
    posts = posts_of((1, 10, "a", 2, 1, None, "t"), (2, 20, "a", 3, 1, None, "t"), (3, 30, "a a", 4, 1, None, "t"))
    found = rec.recommend(requests_of((1, 1, "reply", "a", "q")), posts, users, terms_of())
    assert [r.contact_uid for r in rec.sort_contacts(found).collect()] == [4, 3, 2]


def test_posts_to_oneself_match_twice_and_count_once(posts_of, requests_of, users, terms_of, rows):
    posts = posts_of((1, 10, "go", 1, 1, None, "t,u"))
    got = rows(rec.recommend(requests_of((1, 1, "both", "go", "zz")), posts, users, terms_of()), "matches", "interaction", "overlap")
    assert got == [(2, 2, 4)]


def test_unknown_user_gives_nothing(posts_of, requests_of, users, terms_of, rows):
    posts = posts_of((1, 10, "go", 2, 1, None, "t"))
    assert rows(rec.recommend(requests_of((1, 77, "both", "go", "t")), posts, users, terms_of())) == []


def test_recommendations_agree_with_the_combined_table(posts_of, requests_of, users, terms_of, rows):
    """For one type, matches counted per post are those in the documents; one user takes part in most posts."""
    rng = random.Random(8)

    def uid():
        return rng.choice([1, 1, rng.randrange(1, 12)])

    posts = posts_of(
        *[
            (
                i,
                rng.randrange(20),
                " ".join(rng.choices(["go", "gogo", "Go", "x"], k=4)),
                rng.choice([None, uid()]),
                uid(),
                rng.choice([None, uid()]),
                ",".join(rng.choices(["A", "ab", "b", "pop"], k=3)),
            )
            for i in range(150)
        ]
    )
    wide = combined(posts, users, terms_of("pop"))
    for type_code, word in enumerate(("reply", "retweet")):
        asked = [(u, u, word, "go", "A") for u in range(1, 12)]
        got = rec.recommend(requests_of(*asked), posts, users, terms_of("pop"))
        matches = count_matches(F.col("content"), F.lit("go")) + count_matches(F.lower("hashtags"), F.lit("a"))
        expected = wide.where(F.col("type") == type_code).select(
            "uid", "contact_uid", matches.alias("m"), "interaction", "hashtag_cnt", "latest_post", "screen_name"
        )
        line = F.split("line", "\t")
        assert rows(
            got.select("uid", "contact_uid", "matches", "interaction", "overlap", line[3], line[1])
        ) == rows(expected)


def random_posts(posts_of, count=150, users=12, seed=8):
    rng = random.Random(seed)

    def uid():
        return rng.choice([1, 1, rng.randrange(1, users)])

    return posts_of(
        *[
            (
                i,
                rng.randrange(20),
                " ".join(rng.choices(["go", "gogo", "Go", "x"], k=4)),
                rng.choice([None, uid()]),
                uid(),
                rng.choice([None, uid()]),
                ",".join(rng.choices(["A", "ab", "b", "pop"], k=3)),
            )
            for i in range(count)
        ]
    )


def test_stored_tables_give_the_same(spark, tmp_path, posts_of, requests_of, users, terms_of, rows):
    posts, path = random_posts(posts_of), str(tmp_path)
    serving.write(posts, users, terms_of("pop"), path)
    asked = requests_of(*[(10 * u + k, u, word, "go", "A") for u in (1, 2, 5, 77) for k, word in enumerate(("reply", "retweet", "both"))])
    want = rows(rec.recommend(asked, posts, users, terms_of("pop")).withColumn("score", F.round("score", 9)))
    assert rows(serving.recommend(asked, spark, path).withColumn("score", F.round("score", 9))) == want and want
    assert rows(spark.read.parquet(f"{path}/docs")) == rows(combined(posts, users, terms_of("pop")))
    assert rows(serving.recommend(asked.limit(0), spark, path)) == []


def test_ranges_of_users_reach_the_scans(spark, tmp_path, posts_of, requests_of, users, terms_of):
    posts, path = random_posts(posts_of, 400, users=300), str(tmp_path)
    serving.write(posts, users, terms_of(), path, docs=False)
    asked = requests_of((1, 5, "both", "go", "a"), (2, 290, "both", "go", "a"), (3, 290, "reply", "x", "b"))
    execution = serving.contacts(asked, spark, path)._jdf.queryExecution()
    assert execution.executedPlan().toString().count("GreaterThanOrEqual(uid,5)") == 2
    assert execution.optimizedPlan().toString().count("<= 290)") >= 2
    wide = requests_of(*[(i, 7 * i, "both", "go", "a") for i in range(1000)])
    within = spark.range(7000).select(F.col("id").alias("uid")).where(serving.user_ranges(wide))
    assert within.join(wide, "uid").count() == 1000
    text = within._jdf.queryExecution().optimizedPlan().toString()
    assert text.count(">=") <= serving.RANGES


def test_ranks_follow_the_order_over_many_tasks(spark):
    scored = spark.range(2000).select(
        (F.col("id") % 3).alias("request_id"), (F.col("id") * 7919 % 13).cast("double").alias("score"), F.col("id").alias("contact_uid")
    )
    found = rec.ranked(rec.sort_contacts(scored)).collect()
    for request in range(3):
        own = sorted((r for r in found if r.request_id == request), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1))
        assert [(r.score, r.contact_uid) for r in own] == sorted(((r.score, r.contact_uid) for r in own), reverse=True)


def test_tables_of_some_users_hold_their_rows_only(spark, tmp_path, posts_of, users, terms_of, rows):
    posts, some, whole = random_posts(posts_of), f"{tmp_path}/some", f"{tmp_path}/whole"
    uids = spark.createDataFrame([(2,), (5,), (5,), (77,), (None,)], "uid long")
    serving.write(posts, users, terms_of("pop"), whole)
    serving.write(posts, users, terms_of("pop"), some, uids=uids)
    for name in serving.LAYOUTS:
        want = rows(spark.read.parquet(f"{whole}/{name}").where("uid IN (2, 5)"))
        assert rows(spark.read.parquet(f"{some}/{name}")) == want and want
