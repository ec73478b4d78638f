import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fairstream.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", **{"spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture
def points(spark):
    """Labelled points from text lines."""
    from fairstream.sources.points import labelled_points

    def make(*lines):
        return labelled_points(spark.createDataFrame([(v,) for v in lines], "value string"))

    return make
