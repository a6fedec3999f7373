import json

import pytest

from starling.operators import clean, dedup
from starling.plans import ingest
from starling.sources.files import read_posts

GOOD = {
    "id": 1,
    "id_str": "1",
    "created_at": "Fri Apr 04 05:40:22 +0000 2014",
    "text": "hello",
    "lang": "en",
    "user": {"id": 7, "id_str": "7", "screen_name": "seven", "description": "d", "followers_count": 3},
    "entities": {"hashtags": [{"text": "A", "indices": [0, 2]}, {"text": "b", "indices": [3, 5]}]},
    "favorite_count": 4,
}


@pytest.fixture
def read(spark, tmp_path):
    def build(*posts):
        lines = [p if isinstance(p, str) else json.dumps(p) for p in posts]
        (tmp_path / "raw.json").write_text("\n".join(lines))
        return read_posts(spark, str(tmp_path / "raw.json"))

    return build


def change(**fields):
    return {**GOOD, **fields}


@pytest.mark.parametrize(
    "post",
    [
        change(lang="de"),
        change(id=None, id_str=None),
        change(user={"id": None, "id_str": None}),
        change(created_at="some day"),
        change(text=None),
        change(entities={"hashtags": []}),
        change(entities={"hashtags": None}),
        change(entities=None),
        "{damaged",
        "",
    ],
)
def test_invalid_posts_are_dropped(read, post):
    assert [r.tid for r in ingest.clean_posts(read(change(id=9, id_str="9"), post)).collect()] == [9]


@pytest.mark.parametrize("post", [change(text=""), change(id=None), change(id_str=None), change(id_str="x1")])
def test_valid_posts_are_kept(read, post):
    assert [r.tid for r in ingest.clean_posts(read(post)).collect()] == [1]


def test_topic_posts_need_english_but_no_tags(read):
    kept = ingest.topic_posts(read(change(entities=None), change(id=2, id_str="2", lang="fr")))
    assert [tuple(r) for r in kept.collect()] == [(1, 7, "hello", 1396590022, 3, 4, None)]


def test_profiles_come_from_senders_and_shared_authors(read, rows):
    shared = change(
        id=2,
        id_str="2",
        created_at="Fri Apr 04 06:00:00 +0000 2014",
        retweeted_status={"user": {"id": 8, "id_str": "8", "screen_name": "eight", "description": None}},
        user={"id": 7, "id_str": "7", "screen_name": "seven2", "description": "e"},
    )
    assert rows(ingest.profiles(read(GOOD, shared)), "uid", "screen_name", "description") == [
        (7, "seven2", "e"),
        (8, "eight", None),
    ]


def test_clean_is_one_stage(read):
    plan = ingest.clean_posts(read(GOOD))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_coalesce_ids_folds_every_text_id(spark):
    df = spark.createDataFrame([("1", 2, None, 4)], "a_str string, a long, b_str string, b long")
    assert clean.coalesce_ids(df).collect()[0].asDict() == {"a": 1, "b": 4}


def test_dedup_keeps_one_row_of_each_tid(posts_of, rows):
    posts = posts_of(
        (1, 10, "old", None, 5, None, "x"),
        (1, 20, "new", None, 5, None, "x"),
        (1, 20, "new", None, 5, None, "x"),
        (2, 10, "one", None, 5, None, "x"),
    )
    assert rows(dedup.dedup_posts(posts), "tid", "content") == [(1, "new"), (2, "one")]
    assert rows(dedup.dedup_by_replacement(posts), "tid", "content") == [(1, "new"), (2, "one")]
    assert rows(dedup.duplicate_rows(posts), "tid", "content") == [(1, "new"), (1, "new"), (1, "old")]
    assert rows(dedup.row_ids(posts), "row_id", "tid") == [(1, 1), (2, 1), (3, 1)]


def test_dedup_sends_one_row_per_key_and_task(posts_of):
    plan = dedup.dedup_posts(posts_of((1, 1, "a", None, 1, None, "x")))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below


def test_latest_profile_ties(spark, rows):
    mid = spark.createDataFrame(
        [(1, "a", None, 5), (1, "b", "x", 5), (1, "z", "x", 4), (2, "q", None, 1)],
        "uid long, screen_name string, description string, timestamp long",
    )
    assert rows(dedup.latest_profiles(mid), "uid", "screen_name") == [(1, "b"), (2, "q")]
    assert rows(dedup.latest_rows(mid), "uid", "screen_name") == [(1, "a"), (1, "b"), (2, "q")]
    assert rows(dedup.distinct_users(mid), "uid", "screen_name") == [(1, "a"), (2, "q")]
