import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from featspark.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app="featspark-tests")
    yield s


def rows(df, order=None):
    """Collect as list of dicts, sorted by ``order`` columns."""
    out = [r.asDict() for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple((r[c] is None, r[c]) for c in order))
    return out
