import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ticksmith.session import build_session
    s = build_session("local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="ticksmith-test-")


def _null_safe(t):
    return tuple((0, v) if v is not None else (1, 0) for v in t)


def rows(df, order=None):
    """Rows as tuples, sorted with NULLs last (order-insensitive compare)."""
    cols = order or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_null_safe)
