"""Range joins in two dimensions, and topic answers from stored sums."""

import random

import pytest
from pyspark.sql import functions as F

from starling.operators import ranges, summaries
from starling.plans import topics as plan
from starling.schemas import TOPIC_POST

STOP = ["the", "a"]
REQUEST = "request_id int, uid_start long, uid_end long, time_start long, time_end long, n1 int, n2 int"


def random_posts(spark, count, users=1 << 20, times=1 << 16, seed=1):
    rng = random.Random(seed)
    words = ["cat", "dog", "the", "a", "x-ray", "http://cat.io/owl", "darn", *(f"w{i}" for i in range(40))]
    rows = [
        (
            i,
            rng.choice([77, rng.randrange(users)]),
            " ".join(rng.choices(words, k=rng.randrange(9))),
            rng.choice([5, rng.randrange(times)]),
            rng.randrange(9),
            rng.choice([None, 2]),
            1,
        )
        for i in range(count)
    ]
    return spark.createDataFrame(rows, TOPIC_POST), rows


def random_requests(spark, count, users=1 << 20, times=1 << 16, seed=2):
    rng = random.Random(seed)
    rows = [(0, -5, 1 << 40, -5, 1 << 40, 5, 5), (1, 9, 3, 0, 9, 5, 5), (2, 77, 77, 0, times, 5, 5), (3, 0, users, 5, 5, 5, 5)]
    for i in range(len(rows), count):
        u, t = rng.randrange(users), rng.randrange(times)
        rows.append((i, u, u + rng.choice([0, 99, users // 3, users]), t, t + rng.choice([0, 99, times // 2]), 6, 4))
    return spark.createDataFrame(rows, REQUEST), rows


@pytest.fixture(scope="module")
def stored(spark):
    posts, rows = random_posts(spark, 600)
    grid = summaries.grid_of(posts)._replace(user_levels=(17, 14, 11), time_levels=(13, 10))
    return posts, rows, summaries.summarize(posts, STOP, grid)


def in_request(request, row):
    return request[1] <= row[1] <= request[2] and request[3] <= row[3] <= request[4]


def test_answers_equal_those_without_sums(spark, stored):
    posts, _, sums = stored
    requests, _ = random_requests(spark, 25)
    want = plan.report(requests, posts, STOP, ["darn"])
    got = plan.report(requests, posts, STOP, ["darn"], sums)
    rows = [sorted(tuple(r) for r in x.withColumn("value", F.round("value", 7)).collect()) for x in (got, want)]
    assert rows[0] == rows[1] and len(rows[0]) > 50


def test_a_grid_of_its_own_gives_the_same(spark, stored):
    posts, _, sums = stored
    requests, _ = random_requests(spark, 12)
    own = summaries.summarize(posts, STOP)
    a, b = ({(r.request_id, r.word): (round(r.weight, 9), r.df) for r in summaries.request_words(*summaries.asked(requests, s), s, STOP).collect()} for s in (sums, own))
    assert a == b


def test_inner_cells_and_edges_cover_each_post_once(spark, stored):
    _, rows, sums = stored
    requests, asked = random_requests(spark, 25)
    split = summaries.split_requests(requests, sums.grid)
    cells = [tuple(r) for r in summaries.inner_cells(split).collect()]
    edges = [tuple(r) for r in summaries.edges_of(split).collect()]
    inner = outer = 0
    for request in asked:
        for row in rows:
            by_cell = sum(c[0] == request[0] and row[1] >> c[1] == c[2] and row[3] >> c[3] == c[4] for c in cells)
            by_edge = sum(e[0] == request[0] and e[1] <= row[1] <= e[2] and e[3] <= row[3] <= e[4] for e in edges)
            assert by_cell + by_edge == in_request(request, row)
            inner, outer = inner + by_cell, outer + by_edge
    assert inner > outer > 0  # one user, at an edge of many requests, writes half of the posts


def test_posts_of_inner_cells_are_not_read_again(spark, stored):
    """A request along the borders of cells has no edges: its answer comes from sums alone."""
    posts, rows, sums = stored
    u, t = 3 << 17, 2 << 13
    request = (1, u, u + (2 << 17) - 1, t, t + (3 << 13) - 1, 5, 5)
    requests = spark.createDataFrame([request], REQUEST)
    split, edges = summaries.asked(requests, sums)
    assert edges.count() == 0
    many = sum(in_request(request, r) for r in rows)
    assert summaries.request_sizes(split, edges, sums).collect() == [(1, many)] and many > 0
    inside = [r for r in rows if in_request(request, r)]
    found = {r.word: r.df for r in summaries.request_words(split, edges, sums, STOP).collect()}
    assert found["cat"] == sum("cat" in r[2].replace("//cat", "").split() for r in inside) > 0
    # And with edges, those posts only.
    requests = spark.createDataFrame([(1, u - 50_000, u + (3 << 17) - 9, t - 700, t + (4 << 13) - 9, 5, 5)], REQUEST)
    found = summaries.asked(requests, sums)[1]
    assert found.where(F.col("sender_uid").between(u, u + (2 << 17) - 1) & F.col("timestamp").between(t, t + (3 << 13) - 1)).count() == 0
    assert found.count() > 0


def test_no_posts_and_no_requests(spark, stored):
    posts, _, sums = stored
    requests, _ = random_requests(spark, 5)
    none = summaries.summarize(posts.limit(0), STOP)
    for requests_, stored_ in ((requests, none), (requests.limit(0), sums)):
        split, edges = summaries.asked(requests_, stored_)
        assert summaries.request_scores(split, edges, stored_, STOP).collect() == []
        assert summaries.request_sizes(split, edges, stored_).collect() == []
    assert plan.report(requests, posts.limit(0), STOP, [], none).collect() == []


def test_texts_are_not_split_again(spark, stored):
    """Neither texts nor a list of terms are in the plan that ranks posts."""
    _, _, sums = stored
    requests, _ = random_requests(spark, 5)
    words = spark.createDataFrame([(4, "cat"), (0, "owl")], "request_id int, word string")
    found = summaries.posts_with_words(words, summaries.asked(requests, sums)[0], sums)._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in found and "regexp" not in found and "collect_list" not in found


def test_many_wide_and_short_requests(spark):
    """Posts compared are those of the cells that a request touches: little more than those inside."""
    users, times = 1 << 40, 1 << 24
    rng = random.Random(3)
    posts = spark.range(20_000).select(
        F.col("id").alias("tid"),
        F.pmod(F.xxhash64("id"), F.lit(users)).alias("sender_uid"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(times)).alias("timestamp"),
        F.lit("text").alias("content"),
    )
    asked = [(i, rng.randrange(users // 4), users - rng.randrange(users // 4), t, t + rng.randrange(4000), 1, 1) for i in range(30_000) for t in [rng.randrange(times)]]
    requests = spark.createDataFrame(asked, REQUEST)
    cells = ranges.cover(requests)
    assert cells.groupBy("request_id").count().agg(F.max("count")).first()[0] <= 81
    levels, near = ranges.asked_posts(cells, posts)
    met = ranges.candidates(cells, levels, near)
    compared, found = met.count(), met.where(ranges.inside()).count()
    # At most (1 + 2 / 4) times as wide in either dimension; comparing all would be 600 million.
    assert 0 < found <= compared <= 2.25 * found
    assert ranges.range_join(requests, posts).count() == found


def test_texts_are_fetched_after_the_match(spark, tmp_path):
    random_posts(spark, 50)[0].write.parquet(f"{tmp_path}/posts")
    requests, _ = random_requests(spark, 6)
    cells = ranges.cover(requests)
    levels, near = ranges.asked_posts(cells, spark.read.parquet(f"{tmp_path}/posts"))
    plan_text = ranges.candidates(cells, levels, near)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan_text.split("ReadSchema")[1].split("\n")[0]


def test_words_are_stored_for_the_smallest_cells_only(spark, stored):
    """No word of a cell is stored again for larger ones; numbers alone need no text."""
    posts, rows, sums = stored
    assert sums.words.agg(F.sum("df")).first()[0] == sums.posts.select(F.explode(F.array_distinct("words")).alias("w")).where(~F.col("w").isin(*STOP)).count()
    requests, asked = random_requests(spark, 25)
    alone = summaries.summarize_sizes(posts.drop("content"), sums.grid)
    found = dict(map(tuple, summaries.request_sizes(*summaries.asked(requests, alone), alone).collect()))
    many = {a[0]: sum(in_request(a, r) for r in rows) for a in asked}
    assert found == {k: n for k, n in many.items() if n}
