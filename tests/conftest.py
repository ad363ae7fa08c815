import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tagloom.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8, app="tagloom-tests")
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
