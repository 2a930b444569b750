import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="ledgerloom-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def sf_small():
    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("driver test data not present")
    return d


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
