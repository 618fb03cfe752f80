import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tessera.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[*]", app="tessera-tests", shuffle_partitions=8)
    yield session


def rows(df, *cols):
    """Sorted list of tuples of the named columns (order-insensitive compare)."""
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
