"""Where staged tables go, and which date counts as today."""

import pytest

from helpers import AS_OF
from silverlode import Job, Limits
from silverlode.job import shared_folder


class Session:
    """Stands for a session with given settings."""

    def __init__(self, **settings):
        self.conf = {name.replace("_", "."): value for name, value in settings.items()}


def test_the_cluster_names_the_folder():
    session = Session(spark_master="yarn", spark_checkpoint_dir="hdfs:///shared/")
    assert shared_folder(session) == "hdfs:///shared"


def test_local_mode_may_use_a_temporary_folder():
    assert "silverlode-" in shared_folder(Session(spark_master="local[4]"))


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        shared_folder(Session(spark_master="spark://host:7077"))


def test_jobs_do_not_share_staged_tables(spark):
    assert Job(spark).folder != Job(spark).folder
    assert Job(spark, folder="/x").new_path("a") != Job(spark, folder="/x").new_path("a")


def test_today(spark):
    fixed, clock = spark.range(1).select(Job(spark, AS_OF).today(), Job(spark).today()).first()
    assert fixed == AS_OF and clock >= fixed.replace(year=2020)


def test_hot_limit_grows_with_the_table():
    limits = Limits()
    assert limits.hot_limit(10**6) == 10**6
    assert limits.hot_limit(10**12) == 10**7
