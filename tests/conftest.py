import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewatch.session import local_session

    scratch = tempfile.mkdtemp(prefix="tidewatch-test-")
    s = local_session(8, shuffle_partitions=8, app="tidewatch-tests", scratch=scratch)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tw-")
