import math

import pytest
from pyspark.sql import functions as F

from starling.functions import keys, ledger, scores, text


@pytest.fixture
def value(spark):
    return lambda column: spark.range(1).select(column.alias("v")).first().v


def lit(v):
    return F.lit(v).cast("string") if v is None else F.lit(v)


@pytest.mark.parametrize(
    ("created", "expected"),
    [
        ("Fri Apr 04 05:40:22 +0000 2014", 1396590022),
        ("Fri Apr 04 07:40:22 +0200 2014", 1396590022),
        ("Xyz Apr 04 05:40:22 +0000 2014", 1396590022),
        ("junk", None),
        (None, None),
    ],
)
def test_parse_time(value, created, expected):
    assert value(keys.parse_time(lit(created))) == expected


@pytest.mark.parametrize(
    ("text_id", "number", "expected"), [("12", 13, 12), ("12", None, 12), (None, 13, 13), ("x1", 13, 13), ("x1", None, None)]
)
def test_prefer_text_id(value, text_id, number, expected):
    assert value(keys.prefer_text_id(lit(text_id), F.lit(number).cast("bigint"))) == expected


def test_pair_key_orders_by_number(value):
    assert value(keys.pair_key(F.lit(10), F.lit(9))) == "9_10"
    low, high = keys.split_pair(F.lit("9_10"))
    assert (value(low), value(high)) == (9, 10)


@pytest.mark.parametrize(
    ("tags", "expected"),
    [("a,b", ["a", "b"]), ("a,,b", ["a", "", "b"]), ("a,b,,", ["a", "b"]), (",a", ["", "a"]), (",,", []), ("", [""])],
)
def test_split_tags_drops_empty_items_at_the_end(value, tags, expected):
    assert value(text.split_tags(F.lit(tags))) == expected


@pytest.mark.parametrize(("c", "expected"), [("ab cd", "ab"), ("abcd", ""), (" x", ""), (None, None)])
def test_prefix_until(value, c, expected):
    assert value(text.prefix_until(lit(c), " ")) == expected


def test_join_tags_of_null_is_empty(value):
    assert value(text.join_tags(F.lit(None).cast("array<string>"))) == ""


def test_byte_length(value):
    assert value(text.byte_length(F.lit("aé漢"))) == 6


@pytest.mark.parametrize(
    ("s", "expected"),
    [
        ("see http://a.b/c?d#e now", "see   now"),
        ("a https://x", "a  "),
        ("ftp://f/x\ty", " \ty"),
        ("http:///x stays", "http:///x stays"),
        ("xhttp://a.b y", "x  y"),
    ],
)
def test_strip_urls(value, s, expected):
    assert value(text.strip_urls(F.lit(s))) == expected


def test_words_need_a_letter_and_split_on_other_scripts(value):
    assert value(text.words(F.lit("It's 42 a-1 -- naïve DonKt"))) == ["it's", "a-1", "na", "ve", "don", "t"]


@pytest.mark.parametrize(
    ("s", "pattern", "expected"),
    [("aaa", "aa", 1), ("party art", "art", 2), ("Art", "art", 0), ("x", "", 0), ("", "x", 0), (None, "x", 0)],
)
def test_count_matches(value, s, pattern, expected):
    assert value(text.count_matches(lit(s), F.lit(pattern))) == expected


@pytest.mark.parametrize(
    ("s", "mask_last", "expected"),
    [
        ("ab that x", False, "ab t**t x"),
        ("THAT!", False, "T**T!"),
        ("say that", False, "say that"),
        ("say that", True, "say t**t"),
        ("with-that!", False, "w**h-t**t!"),
        ("éthat that1 .", False, "éthat that1 ."),
        ("\U0001d400that .", False, "\U0001d400t**t ."),
        ("", False, ""),
        ("that\nthat\n", False, "t**t\nt**t\n"),
    ],
)
def test_censor(value, s, mask_last, expected):
    assert value(text.censor(F.lit(s), ["that", "with", "ab", ""], mask_last)) == expected


def test_rot13(value):
    assert value(text.rot13(F.lit("uryyb 1"))) == "hello 1"


def test_format_contact_keeps_missing_fields(value):
    line = text.format_contact(F.lit(5), F.lit(None).cast("string"), F.lit("d"), F.lit(None).cast("string"))
    assert value(line) == "5\t\td\t"


def test_format_topic_rounds_half_up(value):
    assert value(text.format_topic(F.lit("w"), F.lit(2.675))) == "w:2.68"


@pytest.mark.parametrize(("overlap", "expected"), [(0, 1.0), (10, 1.0), (11, 1 + math.log(2)), (20, 1 + math.log(11))])
def test_hashtag_score(value, overlap, expected):
    assert value(scores.hashtag_score(F.lit(overlap))) == pytest.approx(expected)


def test_scores(value):
    assert value(scores.keyword_score(F.lit(0), F.lit(0))) == 1
    assert value(scores.keyword_score(F.lit(2), F.lit(3))) == pytest.approx(1 + math.log(6))
    assert value(scores.interaction_score(F.lit(4))) == pytest.approx(1 + math.log(5))
    assert value(scores.tf_idf(F.lit(1), F.lit(4), F.lit(10), F.lit(10))) == 0
    assert value(scores.impact(F.lit(3), F.lit(None).cast("int"), F.lit(2), F.lit(5))) == 21


@pytest.mark.parametrize(
    ("pos", "reward"), [(0, 500000000), (1, 500000000), (2, 250000000), (5, 125000000), (58, 0), (10**7, 0)]
)
def test_reward_halves_every_second_block(value, pos, reward):
    assert value(ledger.reward_at(F.lit(pos).cast("bigint"))) == reward


@pytest.mark.parametrize(
    ("amount", "expected"), [("12", 12), ("-3", -3), ("1.9", 1), ("8.37259815E7", 83725981), ("x", None), (None, None)]
)
def test_whole_number(value, amount, expected):
    assert value(ledger.whole_number(lit(amount))) == expected
