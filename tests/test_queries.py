"""Every registered query against its SQL twin, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from check import compare, connect
from starling.workload.registry import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tables here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    line = compare(spark, con, name, QUERIES[name], ORACLE[name], FOLDER)
    assert line.startswith("ok"), line


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLE.keys()
    assert entry.queries().keys() >= QUERIES.keys()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


# Queries whose plans may call Python, and only these.
PYTHON = {"ledger_decode", "ledger_explode", "ledger_signature", "ledger_verdict", "q_ledger_verdict"}


@pytest.mark.parametrize(
    "name",
    [
        "q_clean_posts",
        "q_dedup_posts",
        "q_interactions",
        "q_latest_contact",
        "q_combined",
        "q_recommend",
        "q_topics",
        "contact_hashtag_overlap",
        "agg_topic_score",
        "ledger_balance",
        "ledger_block_hash",
        "ledger_verdict",
        "win_split_points",
    ],
)
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    # Only totals that were combined in the tasks before come together in one.
    lines = plan.splitlines()
    gathered = [below for line, below in zip(lines, lines[1:], strict=False) if "Exchange SinglePartition" in line]
    assert all("partial_" in below for below in gathered)
    if name not in PYTHON:
        assert "Python" not in plan and "InPandas" not in plan
