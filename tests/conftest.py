import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    s = build_session("local[*]", app="tidemark-tests", shuffle_partitions=8,
                      extra={"spark.sql.timeType.enabled": "true"})
    yield s
    s.stop()


@pytest.fixture
def tmp_shared(spark):
    """A fresh folder under the shared checkpoint root."""
    from tidemark.session import shared_dir

    return shared_dir(spark, "test")
