import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from starling.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("4", shuffle_partitions=4, memory="6g")


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect


@pytest.fixture(scope="session")
def posts_of(spark):
    """Posts from (tid, timestamp, content, reply_to, sender, retweet_to, hashtags)."""
    from starling.schemas import POST

    def build(*items):
        return spark.createDataFrame([(*item, "en") for item in items], POST)

    return build


@pytest.fixture(scope="session")
def terms_of(spark):
    return lambda *terms: spark.createDataFrame([(t,) for t in terms], "term string")
