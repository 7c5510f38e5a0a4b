import os

import pytest

from tradeloom.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", os.environ.get("TEST_CPUS", "8"))
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])

    return collect
