import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import local_session  # noqa: E402
from helpers import AS_OF  # noqa: E402
from silverlode import Job, Limits  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores="8", partitions=4)


@pytest.fixture
def job(spark):
    return Job(spark, AS_OF)


@pytest.fixture
def hot_job(spark):
    """Limits under which nothing is broadcast as small and three rows make a key hot."""
    return Job(spark, AS_OF, Limits(broadcast_rows=0, hot_rows=2))
