import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# The sample orders and visits of the late-data and daily-UV jobs.
ORDER_TRACE = ["o1,10,10,1634473761000", "o2,10,30,1634473762000", "o4,10,20,1634473764000",
               "o6,10,10,1634473766000", "o5,10,20,1634473765000", "o3,10,20,1634473763000",
               "o10,10,10,1634473770000"]
VISITS = ["app1,1001,1634447599000", "app1,1001,1634451199000", "app1,1001,1634483599000",
          "app1,1002,1634483599000", "app1,1003,1634483599000", "app1,1001,1634486359000",
          "app1,1001,1634486400000", "app1,1001,1634486459000"]


@pytest.fixture(scope="session")
def spark():
    from tidepool.session import local_session
    s = local_session(4, 4, zone="UTC", app="tidepool-tests")
    s.sparkContext.addPyFile(os.path.join(os.path.dirname(os.path.abspath(__file__)), "stubs.py"))
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as sorted tuples (order-insensitive compare)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: [(v is not None, v) for v in t])  # nulls first
