import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from siltstone.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, columns in their own order."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
