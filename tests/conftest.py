import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from scarp.session import build_session, checkpoint_root
    s = build_session("local[4]", app="scarp-tests", shuffle_partitions=4)
    checkpoint_root(s)          # registers a local folder only when the session names none
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_local():
    return tempfile.mkdtemp(prefix="scarp-test-")
