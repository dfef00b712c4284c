import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from medalyst.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("medalyst-tests", master="local[8]", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """Collect a frame as a sorted list of tuples."""
    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
    return collect
