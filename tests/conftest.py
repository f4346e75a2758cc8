import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("POSTALSPARK_DRIVER_MEMORY", "6g")
    from postalspark.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=4, app_name="postalspark-tests")
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
