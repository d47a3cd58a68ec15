import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import get_session
    s = get_session("local[*]", 8, app="quarry-tests")
    yield s


@pytest.fixture()
def tmp_dir():
    # a fresh scratch folder per test (never reused, never cleaned by rm)
    return tempfile.mkdtemp(prefix="quarry-test-")
