from pathlib import Path

import pytest

from starling import session


def test_what_is_stored_can_be_dropped(spark):
    stored = session.materialize(spark.range(5), "numbers")
    folder = Path(session._scratch_of(spark).removeprefix("file:"))
    assert stored.count() == 5 and any(folder.iterdir())
    session.drop_scratch(spark)
    assert not folder.exists()


def test_shuffle_files_of_other_queries_stay(spark):
    before = spark.conf.get(session._DROP_SHUFFLES)
    session.materialize(spark.range(9).groupBy("id").count(), "counts")
    assert spark.conf.get(session._DROP_SHUFFLES) == before


class Cluster:
    """A session of a cluster that names no shared folder."""

    class sparkContext:
        master, applicationId = "yarn", "app-1"

    class conf:
        get = staticmethod(lambda key, default=None: default)


def test_a_cluster_must_name_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_path(Cluster, "x")
