"""Term tables of any size against lists inside expressions."""

import random

import pytest
from pyspark.sql import functions as F

from starling.functions import text
from starling.operators import summaries, terms
from starling.operators import topics as ops
from starling.plans import topics as plan
from starling.schemas import TOPIC_POST
from starling.sources.files import term_list


@pytest.fixture(scope="module")
def many(spark):
    """30,000 terms, and posts in which one word stands everywhere."""
    rand = random.Random(6)
    listed = [f"word{i}" for i in range(29_990)] + ["hot", "ab", "straße", "x-ray", "of", "", "ärger", "fin", "end", "dup"]
    words = ["Hot", "HOT", "cold", "Straße", "ÄRGER", "x-ray", "of", "ab", "http://hot.io/hot", "fin", "😀", "it's", *(f"word{i}" for i in range(50)), *(f"Word{i}" for i in range(29_950, 30_050))]
    rows = [(i % 40, i, " ".join(rand.choices(words, k=rand.randrange(12))) + rand.choice(["", "!", " hot"]), i, 3, None, 1) for i in range(200)]
    rows += [(50, 1, "", 1, 1, 1, 1), (51, 1, None, 1, 1, 1, 1), rows[0], rows[0]]
    table = spark.createDataFrame([(t,) for t in [*listed, "dup", None]], "term string")
    return spark.createDataFrame(rows, TOPIC_POST), table, listed


def test_censoring_by_a_table(many, rows):
    posts, table, listed = many
    for mask_last in (False, True):
        want = posts.withColumn("content", text.censor(F.col("content"), listed, mask_last))
        assert rows(terms.censor(posts, table, "content", mask_last)) == rows(want)
    assert rows(terms.censor(posts, table.limit(0))) == rows(posts)


def test_stop_words_in_a_table(many, rows):
    posts, table, listed = many
    columns = ("tid", "timestamp", "effective", "impact")
    assert rows(ops.with_impact(posts, table), *columns) == rows(ops.with_impact(posts, listed), *columns)
    got, want = (ops.topic_scores(posts.where("content IS NOT NULL"), s).withColumn("score", F.round("score", 9)) for s in (table, listed))
    assert rows(got) == rows(want)


def test_plans_take_tables(spark, many, rows):
    posts, table, _ = many
    posts = posts.where("tid < 40").dropDuplicates(["tid"])
    small = ["hot", "of", "word7", "straße"]
    tables = [spark.createDataFrame([(t,) for t in small], "term string")] * 2
    requests = spark.createDataFrame([(1, 0, 900, 0, 900, 9, 9)], "request_id int, uid_start long, uid_end long, time_start long, time_end long, n1 int, n2 int")
    want = rows(plan.report(requests, posts, small, small).withColumn("value", F.round("value", 7)))
    assert rows(plan.report(requests, posts, *tables).withColumn("value", F.round("value", 7))) == want
    stored = summaries.summarize(posts, tables[0])
    assert rows(plan.report(requests, posts, *tables, stored).withColumn("value", F.round("value", 7))) == want
    with pytest.raises(ValueError):
        term_list(table)


def test_no_list_of_terms_in_the_plan(many):
    posts, table, _ = many
    found = terms.censor(posts, table)._jdf.queryExecution().optimizedPlan().toString()
    assert "word29" not in found and "INSET" not in found
