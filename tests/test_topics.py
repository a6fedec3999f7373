import math
import random
import re

import pytest
from pyspark.sql import functions as F

from starling.operators import topics as ops
from starling.operators.ranges import range_join
from starling.plans import topics as plan
from starling.schemas import TOPIC_POST

STOP = ["the", "a"]


@pytest.fixture
def topic_posts(spark):
    def build(*items):
        return spark.createDataFrame([(tid, uid, c, ts, fol, fav, rt) for tid, uid, c, ts, fol, fav, rt in items], TOPIC_POST)

    return build


@pytest.fixture
def requests_of(spark):
    columns = "request_id int, uid_start long, uid_end long, time_start long, time_end long, n1 int, n2 int"
    return lambda *items: spark.createDataFrame(list(items), columns)


ALL = (1, 0, 100, 0, 100, 10, 10)


def test_scores(topic_posts, rows):
    posts = topic_posts((1, 1, "Cat cat dog", 1, 1, 1, 0), (2, 1, "the dog http://cat.com/cat", 1, 3, None, None), (3, 1, "12 !", 1, 9, 9, 9))
    got = {r.word: r.score for r in ops.topic_scores(posts, STOP).collect()}
    impact_1, impact_2 = 3 * 2, 1 * 3
    assert set(got) == {"cat", "dog"}
    assert got["cat"] == pytest.approx(2 / 3 * math.log(3) * math.log(impact_1 + 1))
    assert got["dog"] == pytest.approx(math.log(3 / 2) * (math.log(impact_1 + 1) / 3 + math.log(impact_2 + 1) / 2))


def test_word_in_every_post_scores_nothing_but_is_kept(topic_posts, requests_of):
    posts = topic_posts((1, 1, "zeta dog", 1, 5, 5, 5), (2, 1, "dog eta", 1, 5, 5, 5))
    words, _ = plan.topics(requests_of(ALL), posts, STOP, [])
    assert [(r.rank, r.word) for r in words.orderBy("rank").collect()] == [(1, "eta"), (2, "zeta"), (3, "dog")]
    assert words.where("word = 'dog'").first().score == 0


def test_post_of_stop_words_has_no_impact(topic_posts, rows):
    assert rows(ops.with_impact(topic_posts((1, 1, "the a THE", 1, 5, 5, 5)), STOP), "effective", "impact") == [(0, 0)]


def test_word_in_a_link_selects_the_post_but_does_not_score(topic_posts, requests_of, rows):
    posts = topic_posts((1, 1, "cat", 1, 1, 1, 1), (2, 1, "see http://x.y/Cat", 1, 50, 50, 50), (3, 1, "dog", 1, 0, 0, 0))
    words, best = plan.topics(requests_of((1, 0, 100, 0, 100, 1, 10)), posts, STOP, [])
    chosen = words.first().word
    assert chosen == "see"
    words, best = plan.topics(requests_of((1, 0, 100, 0, 100, 2, 10)), posts, STOP, [])
    assert {r.word for r in words.collect()} == {"see", "cat"}
    assert [(r.rank, r.tid) for r in best.orderBy("rank").collect()] == [(1, 2), (2, 1)]


def test_duplicated_posts_count_once(topic_posts, requests_of, rows):
    one = (1, 1, "cat dog", 1, 1, 1, 1)
    words, best = plan.topics(requests_of(ALL), topic_posts(one, one, (2, 1, "dog", 1, 1, 1, 1)), STOP, [])
    assert rows(best, "tid") == [(1,), (2,)]
    assert words.where("word = 'cat'").first().score == pytest.approx(0.5 * math.log(2) * math.log(7))


def test_report_masks_banned_words(topic_posts, requests_of):
    posts = topic_posts((1, 1, "darn cat and darn", 1, 1, 1, 1), (2, 1, "dog", 1, 1, 1, 1))
    lines = {(r.kind, r["rank"]): r.text for r in plan.report(requests_of((1, 0, 9, 0, 9, 9, 1)), posts, STOP, ["darn"]).collect()}
    assert "d**n" in lines.values()
    assert lines[("post", 1)] == "12\t1\td**n cat and darn"


def test_each_request_has_its_own_limits(topic_posts, requests_of):
    posts = topic_posts(*[(i, i, f"w{i} common x{i}", i, i, 1, 1) for i in range(1, 20)])
    asked = requests_of((1, 1, 10, 0, 99, 6, 3), (2, 5, 19, 0, 99, 4, 1), (3, 9, 1, 0, 99, 4, 4))
    words, best = plan.topics(asked, posts, STOP, [])
    assert {r.request_id: r["count"] for r in words.groupBy("request_id").count().collect()} == {1: 6, 2: 4}
    assert {r.request_id: r["count"] for r in best.groupBy("request_id").count().collect()} == {1: 3, 2: 1}


def test_large_lists_are_ranked_in_parts_first(spark):
    words = spark.range(20_000).selectExpr("1 AS request_id", "concat('w', id) AS word", "id * 7919 % 20011 + 0.0 AS score")
    limits = spark.createDataFrame([(1, 5000)], "request_id int, n1 int")
    found = plan._top(words, "word", ops.rank_words(), limits, "n1", 5000).orderBy("rank")
    want = words.orderBy(*ops.rank_words()).limit(5000)
    assert [r.word for r in found.collect()] == [r.word for r in want.collect()]
    assert "pmod(xxhash64(word" in found._jdf.queryExecution().optimizedPlan().toString()


def test_bounds_of_the_requests_reach_the_scan(spark, tmp_path):
    spark.range(1000).selectExpr("id AS sender_uid", "id AS timestamp", "'x' AS content").write.parquet(f"{tmp_path}/posts")
    requests = spark.createDataFrame(
        [(1, 10, 20, 0, 99), (2, 15, 40, 5, 30)],
        "request_id long, uid_start long, uid_end long, time_start long, time_end long",
    )
    found = range_join(requests, spark.read.parquet(f"{tmp_path}/posts"))
    assert "GreaterThanOrEqual(sender_uid,10)" in found._jdf.queryExecution().executedPlan().toString()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert all(bound in plan for bound in (">= 10)", "<= 40)", ">= 0)", "<= 99)"))
    assert found.groupBy("request_id").count().orderBy("request_id").collect() == [(1, 11), (2, 16)]
    assert range_join(requests.limit(0), spark.read.parquet(f"{tmp_path}/posts")).collect() == []


def test_range_join_equals_the_inequality_join(spark, rows):
    rng = random.Random(5)
    # One user writes a third of the posts.
    posts = [(i, 500 if i % 3 == 0 else rng.randrange(1 << 40), rng.randrange(1000)) for i in range(600)]
    asked = []
    for i in range(40):
        a = rng.choice([0, 500, rng.randrange(1 << 40)])
        width = rng.choice([0, 1, 63, 64, 65, 1000, 1 << 20, 1 << 40])
        t = rng.randrange(1000)
        asked.append((i, a, a + width, t, t + rng.choice([-1, 0, 100, 1000])))
    p = spark.createDataFrame(posts, "tid long, sender_uid long, timestamp long")
    r = spark.createDataFrame(asked, "request_id int, uid_start long, uid_end long, time_start long, time_end long")
    expected = sorted(
        ((i, tid) for i, a, b, t0, t1 in asked for tid, u, ts in posts if a <= u <= b and t0 <= ts <= t1), key=repr
    )
    joined = range_join(r, p)
    assert rows(joined, "request_id", "tid") == expected
    plan_text = joined._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan_text and "NestedLoop" not in plan_text


def test_posts_with_terms(topic_posts, rows):
    posts = topic_posts((1, 1, "Cats http://x/cat", 1, 1, 1, 1), (2, 1, "cats", 1, 1, 1, 1))
    assert rows(ops.posts_with_terms(posts, ["cat"]), "tid") == [(1,)]
    assert rows(ops.posts_with_terms(posts, []), "tid") == []


def test_term_counts(topic_posts, rows):
    posts = topic_posts((1, 1, "b B a 7", 1, 1, 1, 1))
    assert rows(ops.term_counts(posts)) == [(1, "a", 1, 3), (1, "b", 2, 3)]
    assert rows(ops.doc_freq(posts)) == [("a", 1), ("b", 1)]
    assert rows(posts.select(F.size(ops.post_words(F.col("content"))))) == [(3,)]


def test_topics_against_brute_force(topic_posts, requests_of):
    rng = random.Random(11)
    vocabulary = ["cat", "Dog", "it's", "the", "a", "x-ray", "42", "http://cat.io/owl", "owl", "darn"]
    posts = [
        (
            i % 50,
            rng.randrange(10),
            " ".join(rng.choices(vocabulary, k=rng.randrange(0, 9))),
            rng.randrange(10),
            rng.randrange(9),
            rng.choice([None, 1, 2]),
            rng.choice([None, 3]),
        )
        for i in range(50)
    ]
    asked = [(1, 0, 9, 0, 9, 4, 6), (2, 2, 6, 1, 8, 2, 3), (3, 3, 3, 0, 9, 99, 99)]
    words, best = plan.topics(requests_of(*asked), topic_posts(*posts, *posts[:10]), STOP, ["darn"])

    def terms(text, links):
        text = text if links else re.sub(r"(https?|ftp)://[^\t\r\n /$.?#][^\t\r\n ]*", " ", text)
        return [w.lower() for w in re.split(r"[^a-zA-Z0-9'-]+", text)]

    for request, u0, u1, t0, t1, n1, n2 in asked:
        inside = {p[0]: p for p in posts if u0 <= p[1] <= u1 and t0 <= p[3] <= t1}
        lists = {tid: [w for w in terms(p[2], False) if re.search("[a-z]", w)] for tid, p in inside.items()}
        impact = {
            tid: sum(w not in STOP for w in lists[tid]) * sum(c or 0 for c in p[4:]) for tid, p in inside.items()
        }
        score = {}
        for word in {w for ws in lists.values() for w in ws} - set(STOP):
            df = sum(word in ws for ws in lists.values())
            score[word] = sum(
                ws.count(word) / len(ws) * math.log(len(inside) / df) * math.log(impact[tid] + 1)
                for tid, ws in lists.items()
                if word in ws
            )
        top = sorted(score, key=lambda w: (-round(score[w], 9), w))[:n1]
        got = words.where(F.col("request_id") == request).orderBy("rank").collect()
        assert [r.word for r in got] == top
        assert [r.score for r in got] == pytest.approx([score[w] for w in top])
        chosen = [tid for tid, p in inside.items() if set(terms(p[2], True)) & set(top)]
        ranked = sorted(chosen, key=lambda tid: (-impact[tid], -tid))[:n2]
        assert [r.tid for r in best.where(F.col("request_id") == request).orderBy("rank").collect()] == ranked


def test_words_are_counted_inside_their_post(spark, rows):
    """Without a shuffle of words; rows of one tid and length count together, those of no tid as well."""
    texts = [(1, "b a b"), (2, ""), (3, None), (4, "x y"), (4, "y z"), (4, "y"), (None, "q"), (None, "q"), (5, "7 -")]
    posts = spark.createDataFrame(texts, "tid long, content string")
    want = [(1, "a", 1, 3), (1, "b", 2, 3), (4, "x", 1, 2), (4, "y", 2, 2), (4, "z", 1, 2), (4, "y", 1, 1), (None, "q", 2, 1)]
    assert rows(ops.term_counts(posts)) == sorted(want, key=repr)
    plan = ops.term_counts(posts.where("tid < 4"))._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "word" not in "".join(x for x in plan.splitlines() if "Exchange" in x)
